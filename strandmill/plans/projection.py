"""Structural-variant tables projected from the star-schema test tables, in expressions that Spark SQL and DuckDB share.

Each table is a FROM clause and a list of (expression, name); spark_table() makes a DataFrame of it and
cte() the text of a common table expression, so a query and its SQL twin read the same rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES: dict[str, tuple[str, str, list[tuple[str, str]]]] = {
    "sig": ("lineitem", "", [
        ("concat('Chr', cast(l_suppkey % 5 + 1 as varchar(10)))", "chrom"), ("concat('r', cast(l_orderkey as varchar(20)))", "query_name"),
        ("cast(l_partkey * 2000 + l_orderkey % 60 as bigint)", "start"),
        ("cast(case when l_linenumber % 4 = 1 then l_partkey * 2000 + l_orderkey % 60 + 1 else l_partkey * 2000 + l_orderkey % 60 + 40 + cast(l_quantity as bigint) * 20 - 1 end as bigint)", "stop"),
        ("cast(40 + cast(l_quantity as bigint) * 20 as bigint)", "sv_len"),
        ("case l_linenumber % 4 when 0 then 'DEL' when 1 then 'INS' when 2 then 'DUP' else 'INV' end", "sv_type"), ("cast(20 + l_partkey % 41 as int)", "maq"),
        ("concat('id', cast(l_orderkey as varchar(20)), '_', cast(l_linenumber as varchar(20)), '_', cast(l_partkey as varchar(20)), '_', cast(l_suppkey as varchar(20)))", "svid"), ("'*'", "seq"),
        ("cast(1 + l_orderkey % 7 as bigint)", "cluster_size"), ("cast(1 + l_orderkey % 10 as double) / 10", "sv_rate"),
        ("cast(l_orderkey as bigint)", "k1"), ("cast(l_linenumber as bigint)", "k2"), ("cast(l_partkey as bigint)", "k3"), ("cast(l_suppkey as bigint)", "k4"),
    ]),
    "cov": ("orders", "", [
        ("concat('Chr', cast(o_custkey % 5 + 1 as varchar(10)))", "chrom"), ("cast((o_orderkey * 2654 + o_custkey) % 4000000 as bigint)", "start"),
        ("cast((o_orderkey * 2654 + o_custkey) % 4000000 + 2000 + o_orderkey % 9000 as bigint)", "stop"), ("cast(o_orderkey as bigint)", "read_id"),
    ]),
    "gene": ("part", "", [
        ("concat('g', cast(p_partkey as varchar(20)))", "gene"), ("concat('Chr', cast(p_partkey % 5 + 1 as varchar(10)))", "chrom"),
        ("cast(p_partkey * 2000 + 10 as bigint)", "start"), ("cast(p_partkey * 2000 + 1510 + p_size * 20 as bigint)", "stop"), ("case when p_size % 2 = 0 then '+' else '-' end", "strand"),
    ]),
    "gt": ("events", "", [
        ("concat('v', cast(event_id % 500 as varchar(20)))", "id"), ("concat('Chr', cast(event_id % 5 + 1 as varchar(10)))", "chrom"), ("cast((event_id % 500) * 1000 as bigint)", "pos"),
        ("concat('s', cast(10 + user_id % 8 as varchar(20)))", "sample"),
        ("case when (event_id * 7 + user_id) % 10 < 5 then '0/0' when (event_id * 7 + user_id) % 10 < 7 then '0/1' when (event_id * 7 + user_id) % 10 < 9 then '1/1' else './.' end", "gt"),
        ("cast(event_id as bigint)", "event_id"),
    ]),
    "ratio": ("lineitem", "", [
        ("cast(l_orderkey as bigint)", "k1"), ("cast(l_linenumber as bigint)", "k2"), ("cast(l_partkey as bigint)", "k3"), ("cast(l_suppkey as bigint)", "k4"),
        ("cast(l_partkey % 14 as bigint)", "support"), ("cast(l_orderkey % 16 as bigint)", "depth"), ("cast(l_partkey % 101 as double) / 100", "a"), ("cast(l_orderkey % 101 as double) / 100", "b"),
        ("cast(l_suppkey % 5 as bigint)", "spans"), ("cast(40 + cast(l_quantity as bigint) * 40 as bigint)", "size"),
    ]),
    "align": ("lineitem", "", [
        ("concat('q', cast(l_orderkey as varchar(20)), '_', cast(l_partkey as varchar(20)), '_', cast(l_suppkey as varchar(20)), '_', cast(l_linenumber as varchar(20)))", "qname"),
        ("cast(case when l_suppkey % 2 = 0 then 0 else 16 end as int)", "flag"), ("concat('Chr', cast(l_suppkey % 5 + 1 as varchar(10)))", "rname"),
        ("cast(l_partkey * 100 as bigint)", "pos"), ("cast(20 + l_partkey % 41 as int)", "mapq"),
        ("concat(case when l_orderkey % 4 = 0 then '3000M' else concat(cast(1 + l_orderkey % 900 as varchar(9)), 'S') end, cast(100 + l_partkey % 400 as varchar(9)), 'M', cast(1 + l_suppkey % 90 as varchar(9)), case when l_linenumber % 2 = 0 then 'D' else 'I' end, cast(50 + l_orderkey % 300 as varchar(9)), '=', cast(1 + l_partkey % 70 as varchar(9)), 'D', '30M', case when l_orderkey % 4 = 0 then '' else concat(cast(1 + l_partkey % 800 as varchar(9)), 'H') end)", "cigar"),
        ("repeat('ACGT', 500)", "seq"), ("case when l_orderkey % 4 <> 0 then concat('Chr', cast((l_suppkey + case when l_orderkey % 3 = 0 then 1 else 0 end) % 5 + 1 as varchar(9)), ',', cast(l_partkey * 100 + (l_suppkey % 7) * 700 as varchar(20)), case when l_partkey % 3 = 0 then ',+' else ',-' end, ',60S', cast(100 + l_orderkey % 900 as varchar(9)), 'M5D10I,60,0;Chr', cast(l_suppkey % 5 + 1 as varchar(9)), ',', cast(l_partkey * 100 + 2000 as varchar(20)), ',+,90M9H,7,1;') end", "sa"), ("concat('s', cast(l_orderkey % 3 as varchar(9)))", "sample"),
    ]),
    "pair": ("part", "", [
        ("concat('p', cast(p_partkey as varchar(20)))", "vid"), ("case p_partkey % 3 when 0 then 'DUP' when 1 then 'INV' else 'TRA' end", "sv_type"), ("concat('Chr', cast(p_partkey % 5 + 1 as varchar(10)))", "chrom"), ("cast(p_partkey * 100 + 1200 as bigint)", "start"),
        ("concat('Chr', cast((p_partkey + case when p_partkey % 3 = 2 then 1 else 0 end) % 5 + 1 as varchar(10)))", "chrom2"), ("cast(p_partkey * 100 + 1240 + case when p_partkey % 3 = 2 then 1800 else p_size * p_size * 2 end as bigint)", "stop"), ("cast(case when p_partkey % 3 = 2 then 0 else 40 + p_size * p_size * 2 end as bigint)", "size"),
    ]),
    "var": ("part", "", [
        ("concat('v', cast(p_partkey as varchar(20)))", "vid"), ("concat('Chr', cast(p_partkey % 5 + 1 as varchar(10)))", "chrom"), ("cast(p_partkey * 100 + 1200 as bigint)", "start"),
        ("cast(p_partkey * 100 + 1200 + case when p_partkey % 2 = 0 then 1 else 30 + p_size end as bigint)", "stop"), ("cast(30 + p_size as bigint)", "size"), ("case when p_partkey % 2 = 0 then 'INS' else 'DEL' end", "sv_type"),
    ]),
    "piece": ("lineitem", "", [
        ("concat('q', cast(l_orderkey as varchar(20)))", "qname"),
        ("cast(case when l_linenumber = 1 then 0 else 2048 end + case when l_suppkey % 3 = 0 then 16 else 0 end as int)", "flag"), ("concat('Chr', cast(l_suppkey % 2 + 1 as varchar(10)))", "chrom"),
        ("cast(100000 + l_orderkey % 700 + l_linenumber * 900 + l_partkey % 500 as bigint)", "start"), ("cast(100000 + l_orderkey % 700 + l_linenumber * 900 + l_partkey % 500 + 800 + l_suppkey % 90 as bigint)", "stop"),
        ("cast((l_linenumber - 1) * 900 + l_partkey % 300 as bigint)", "cl"), ("cast(800 + l_suppkey % 90 as bigint)", "cm"), ("cast((7 - l_linenumber) * 900 + l_partkey % 200 as bigint)", "cr"),
        ("cast(case when l_partkey % 5 = 0 then 20 else 60 end as int)", "mapq"), ("cast(l_partkey as bigint)", "k3"), ("cast(l_suppkey as bigint)", "k4"),
    ]),
    "name": ("orders", "", [
        ("cast(o_orderkey % 300 as bigint)", "vid"), ("concat('r', cast(o_custkey % 90 as varchar(20)))", "qname"), ("cast(o_orderkey % 2 as int)", "side"),
    ]),
    "dna": ("documents", "where text is not null", [
        ("cast(doc_id as bigint)", "doc_id"), ("translate(regexp_replace(lower(text), '[^a-z]', '', 'g'), 'abcdefghijklmnopqrstuvwxyz', 'ACGTACGTACGTACGTACGTACGTAC')", "seq"),
    ]),
    "inv": ("supplier", "", [
        ("concat('Chr', cast(s_suppkey % 5 + 1 as varchar(10)))", "chrom"), ("cast((s_suppkey * 37003) % 390000 as bigint)", "start"), ("cast((s_suppkey * 37003) % 390000 + 20000 + (s_suppkey * 1301) % 90000 as bigint)", "stop"),
    ]),
    "snp": ("part", "", [
        ("concat('c', cast(p_partkey % 4 as varchar(9)))", "chrom"), ("cast(1000 + (p_partkey * 37) % 3000 as bigint)", "pos"),
        ("substr('ACGT', cast(p_partkey % 4 + 1 as int), 1)", "con"), ("substr('ACGT', cast((p_partkey + 1 + p_partkey % 3) % 4 + 1 as int), 1)", "mut"),
        ("cast(p_size % 10 as double) / 10", "con_freq"), ("cast(p_size % 7 as double) / 10", "mut_freq"),
    ]),
    "pile": ("events", "", [
        ("concat('Chr', cast(event_id % 5 + 1 as varchar(10)))", "chrom"), ("cast(event_id as bigint)", "pos"), ("concat('7;', repeat('.', cast(event_id % 6 as int)), '^I', repeat('a', cast(user_id % 4 as int)), repeat('T', cast((event_id + user_id) % 3 as int)), '$', repeat('g', cast(event_id % 2 as int)), ';IAI', repeat(';2;,.;FF', cast(event_id % 9 as int)))", "cols"),
    ]),
    "info": ("events", "", [
        ("cast(event_id as bigint)", "event_id"), ("cast(user_id as bigint)", "pos"),
        ("concat('SVTYPE=', case when event_id % 2 = 0 then 'DEL' else 'TRA' end, ';END=', case when event_id % 2 = 0 then '' else 'Chr2:' end, cast(user_id + 500 as varchar(20)), ';SVLEN=', cast(event_id % 900 as varchar(20)), case when event_id % 3 = 0 then concat(';SV_START=', cast(user_id + 3 as varchar(20))) else '' end)", "info"),
    ]),
}


def _spark(expression: str) -> str:
    return expression.replace(", '', 'g')", ", '')").replace("varchar(20)", "string").replace("varchar(10)", "string").replace("varchar(9)", "string")


def spark_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    source, condition, columns = TABLES[name]
    table = spark.read.parquet(f"{sf_dir}/{source}.parquet")
    if condition:
        table = table.where(condition.removeprefix("where "))
    return table.selectExpr(*[f"{_spark(e)} as `{n}`" for e, n in columns])


def cte(*names: str) -> str:
    """WITH text of the named tables, without a closing comma."""
    parts = []
    for name in names:
        source, condition, columns = TABLES[name]
        parts.append(f"{name} AS (SELECT {', '.join(f'{e} AS {n}' for e, n in columns)} FROM {source} {condition})")
    return "WITH RECURSIVE " + ", ".join(parts)
