"""Queries on alignments, genotypes, cohorts, genes, nested variants and markers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from strandmill.functions import scalars
from strandmill.operators import alignments, annotation, clusters, cohort, filters, genotypes, intervals, markers, nested, sequences
from strandmill.plans.catalog import query
from strandmill.plans.projection import cte, spark_table
from strandmill.plans.signals import sig

K = ["k1", "k2", "k3", "k4"]

OPS = cte("align") + r""", ops AS (SELECT *, regexp_extract_all(cigar, '([0-9]+)([MIDNSHP=X])', 1) AS ns, regexp_extract_all(cigar, '([0-9]+)([MIDNSHP=X])', 2) AS os FROM align),
op AS (SELECT qname, flag, rname, pos, mapq, sample, seq, i, CAST(ns[i] AS BIGINT) AS n, os[i] AS op FROM (SELECT *, unnest(range(1, len(ns) + 1)) AS i FROM ops)),
pl AS (SELECT *, pos + coalesce(CAST(sum(CASE WHEN op IN ('M', 'D', 'N', '=', 'X') THEN n ELSE 0 END) OVER w AS BIGINT), 0) AS ref, coalesce(CAST(sum(CASE WHEN op IN ('M', 'I', 'S', '=', 'X') THEN n ELSE 0 END) OVER w AS BIGINT), 0) AS query FROM op WINDOW w AS (PARTITION BY qname ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))"""


def align(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark_table(spark, sf_dir, "align")


@query(OPS + " SELECT qname, CAST(i - 1 AS INT) AS k, op, n, ref, query FROM pl")
def cigar_explode(spark: SparkSession, sf_dir: str) -> DataFrame:
    ops = align(spark, sf_dir).select("qname", F.posexplode(alignments.placed(F.col("cigar"), F.col("pos"))).alias("k", "o"))
    return ops.select("qname", "k", "o.op", "o.n", "o.ref", "o.query")


@query(OPS + """ SELECT qname, max(CASE WHEN i = 1 AND op IN ('S', 'H') THEN n ELSE 0 END) AS "left", CAST(sum(CASE WHEN op IN ('M', 'N', 'P', '=', 'X', 'I') THEN n ELSE 0 END) AS BIGINT) AS mapped,
max(CASE WHEN i > 1 AND op = 'H' THEN n ELSE 0 END) AS "right" FROM pl GROUP BY qname""")
def cigar_clip_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align(spark, sf_dir).select("qname", alignments.clips(F.col("cigar")).alias("c")).select("qname", "c.left", "c.mapped", "c.right")


@query(OPS + """ SELECT rname AS chrom, qname AS query_name, ref AS start, CASE WHEN op = 'D' THEN ref + n - 1 ELSE ref + 1 END AS stop, n AS sv_len, mapq AS maq, CASE op WHEN 'D' THEN 'DEL' ELSE 'INS' END AS sv_type,
CASE op WHEN 'D' THEN '*' ELSE substr(seq, query + 1, n) END AS seq, concat(rname, ':', ref, '-', CASE WHEN op = 'D' THEN ref + n - 1 ELSE ref + 1 END, '_', CASE op WHEN 'D' THEN 'DEL' ELSE 'INS' END, '=', n) AS svid
FROM pl WHERE op IN ('D', 'I') AND n >= 40 AND mapq >= 30 AND flag IN (0, 16, 2048, 2064)""")
def cigar_signals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignments.cigar_signals(filters.signal_reads(align(spark, sf_dir)))


@query(OPS + " SELECT rname AS chrom, ref AS pos, count(*) AS n FROM pl WHERE op IN ('S', 'H') AND n >= 500 GROUP BY ALL")
def clip_breakpoints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignments.clip_breakpoints(align(spark, sf_dir)).groupBy("chrom", "pos").agg(F.count(F.lit(1)).alias("n"))


@query(cte("piece") + """, s AS (SELECT DISTINCT qname, rname, pos FROM (SELECT qname, chrom AS rname, start AS pos, k3 FROM piece)),
t AS (SELECT qname, string_agg(concat(rname, ',', pos, ',+,30S40M5D,60,0;'), '' ORDER BY rname, pos) AS sa FROM s GROUP BY qname), p AS (SELECT qname, unnest(string_split(rtrim(sa, ';'), ';')) AS x FROM t)
SELECT qname, split_part(x, ',', 1) AS chrom, CAST(split_part(x, ',', 2) AS BIGINT) AS pos, split_part(x, ',', 3) AS strand, split_part(x, ',', 4) AS cigar, CAST(split_part(x, ',', 5) AS INT) AS mapq FROM p""")
def sa_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = spark_table(spark, sf_dir, "piece").select("qname", "chrom", "start").distinct()
    tagged = parts.groupBy("qname").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("chrom", "start"))), lambda s: F.concat(s["chrom"], F.lit(","), s["start"], F.lit(",+,30S40M5D,60,0;"))), "").alias("sa"))
    return tagged.select("qname", F.explode(alignments.sa_segments(F.col("sa"))).alias("s")).select("qname", "s.*")


PAIRS = cte("piece") + """, p AS (SELECT DISTINCT qname, flag, chrom, start, stop, cl, cm, cr, mapq FROM piece),
pq AS (SELECT p.qname, p, q, CASE WHEN q.start > p.start THEN p ELSE q END AS l, CASE WHEN q.start > p.start THEN q ELSE p END AS r FROM p JOIN p q ON p.qname = q.qname AND p.flag <= 16 AND q.flag > 16 AND q.cm >= 300),
z AS (SELECT qname, l.chrom AS chrom, l.chrom = r.chrom AS same_chrom, floor((l.mapq + r.mapq) / 2) AS maq, (l.flag & 16) = (r.flag & 16) AS same, l.start AS ls, l.stop AS le, r.start AS rs, r.stop AS re, l.cl + l.cm - r.cl AS lap1, r.cl + r.cm - l.cl AS lap2, r.cl - l.cm - l.cl AS ins0, r.cl + r.cm - l.cr AS inv1, r.cr + r.cm - l.cl AS inv2 FROM pq),
y AS (SELECT *, NOT same AND ls < rs AND re - le > -200 AS turned FROM z WHERE same_chrom AND maq >= 30),
o AS (
 SELECT qname, chrom, maq, 'DEL' AS sv_type, greatest(0, le - greatest(0, lap1)) AS start, rs - le + lap1 AS sv_len, rs - le + lap1 - 1 AS reach FROM y WHERE same AND lap1 > -200 AND lap1 < 1500
 UNION ALL SELECT qname, chrom, maq, 'INS', least(rs, le), ins0 - (rs - le), 1 FROM y WHERE same AND abs(rs - le) <= 300
 UNION ALL SELECT qname, chrom, maq, 'DUP', rs, le - rs - greatest(lap1, 0), le - rs - greatest(lap1, 0) FROM y WHERE same AND lap1 > -200 AND lap1 < 500 AND le - rs >= greatest(50, lap1)
 UNION ALL SELECT qname, chrom, maq, 'DUP', ls, re - ls - lap2, re - ls - lap2 FROM y WHERE same AND lap2 > -200 AND lap2 < 500 AND re - ls >= greatest(1000, lap2)
 UNION ALL SELECT qname, chrom, maq, 'INV', le, re - le - inv1, re - le - inv1 FROM y WHERE turned AND inv1 > -200 AND inv1 < 500 AND re - le > greatest(100, inv1)
 UNION ALL SELECT qname, chrom, maq, 'INV', ls, rs - ls - inv2, rs - ls - inv2 FROM y WHERE turned AND inv2 > -200 AND inv2 < 500 AND rs - ls >= greatest(100, inv2))
SELECT chrom, qname AS query_name, start, start + reach AS stop, sv_len, CAST(maq AS INT) AS maq, sv_type FROM o WHERE sv_len >= 40"""


def _clipped(table: DataFrame) -> DataFrame:
    return table.select("qname", "flag", "chrom", "start", "stop", F.struct(F.col("cl").alias("left"), F.col("cm").alias("mapped"), F.col("cr").alias("right")).alias("clip"), "mapq")


def pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _clipped(spark_table(spark, sf_dir, "piece").drop("k3", "k4").distinct())


@query(PAIRS)
def split_read_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignments.split_signals(alignments.segment_pairs(pieces(spark, sf_dir))).drop("svid", "seq")


@query(PAIRS.split(",\nz AS (")[0] + """,
t AS (SELECT qname, p.chrom AS a, q.chrom AS b,
 CASE WHEN abs(p.cl - q.cl - q.cm) <= 500 OR abs(p.cl - q.cm - q.cr) <= 500 THEN p.start WHEN abs(p.cr - q.cl - q.cm) <= 500 OR abs(p.cr - q.cm - q.cr) <= 500 THEN p.stop END AS x,
 CASE WHEN abs(q.cl - p.cl - p.cm) <= 500 OR abs(q.cl - p.cm - p.cr) <= 500 THEN q.start WHEN abs(q.cr - p.cl - p.cm) <= 500 OR abs(q.cr - p.cm - p.cr) <= 500 THEN q.stop END AS y
 FROM pq WHERE p.chrom <> q.chrom AND floor((p.mapq + q.mapq) / 2) = 60)
SELECT CASE WHEN a > b THEN b ELSE a END AS chrom, qname AS query_name, CASE WHEN a > b THEN y ELSE x END AS start, CASE WHEN a > b THEN a ELSE b END AS chrom2, CASE WHEN a > b THEN x ELSE y END AS start2 FROM t WHERE x IS NOT NULL AND y IS NOT NULL""")
def split_read_translocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    order = spark.createDataFrame([("Chr1", 1), ("Chr2", 2)], "chrom string, rank int")
    return alignments.translocation_signals(alignments.segment_pairs(pieces(spark, sf_dir)), order).select("chrom", "query_name", "start", "chrom2", "start2")


def short_pieces(spark: SparkSession, sf_dir: str, once: bool = True) -> DataFrame:
    """The pieces with mapped lengths to 699, so that the bounds on them matter; once: equal ones are one."""
    mapped = (F.col("clip.mapped") * 7) % 700
    short = _clipped(spark_table(spark, sf_dir, "piece")).withColumns({"stop": F.col("start") + mapped, "clip": F.struct(F.col("clip.left").alias("left"), mapped.alias("mapped"), F.col("clip.right").alias("right"))})
    return short.distinct() if once else short


SHORT = PAIRS.replace("SELECT DISTINCT qname, flag, chrom, start, stop, cl, cm, cr, mapq FROM piece", "SELECT DISTINCT qname, flag, chrom, start, start + (cm * 7) % 700 AS stop, cl, (cm * 7) % 700 AS cm, cr, mapq FROM piece")


@query(SHORT)
def split_read_short(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of any length: a short primary still counts, short supplements don't."""
    return alignments.split_signals(alignments.segment_pairs(short_pieces(spark, sf_dir))).drop("svid", "seq")


_ALL = SHORT.replace("maq >= 30", "maq = 60")
_FIRST = _ALL.replace("pq AS (", "k AS (SELECT *, row_number() OVER (PARTITION BY qname ORDER BY chrom, start, flag, stop) AS k, min(flag) OVER (PARTITION BY qname) AS least FROM p),\npq AS (").replace("FROM p JOIN p q ON p.qname = q.qname AND p.flag <= 16 AND q.flag > 16 AND q.cm >= 300)", "FROM k p JOIN k q ON p.qname = q.qname AND p.k = 1 AND q.k > 1 AND p.least <= 16 AND q.cm >= 250)")


@query(_FIRST + " AND (sv_type <> 'INV' OR sv_len < CASE chrom WHEN 'Chr1' THEN 3000 ELSE 200000 END / 4)")
def split_assembly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Signals of contigs: the piece of smallest place is the primary, qualities are 60, inversions are under a quarter of the chromosome."""
    sizes = spark.createDataFrame([("Chr1", 3000), ("Chr2", 200000)], "chrom string, size long")
    found = alignments.split_signals(alignments.segment_pairs(short_pieces(spark, sf_dir), assembly=True), exact_mapq=60)
    return filters.inversion_guard(found, sizes).drop("svid", "seq")


_EACH = """FROM p JOIN p q ON p.qname = q.qname AND p.chrom = q.chrom AND ((p.start < q.start AND (p.cm >= 250 OR q.cm >= 250)) OR (p.start = q.start AND p.cm >= 250 AND (p.flag, p.stop, p.cl, p.cm, p.cr, p.mapq) <> (q.flag, q.stop, q.cl, q.cm, q.cr, q.mapq))))"""


@query(_ALL.replace("FROM p JOIN p q ON p.qname = q.qname AND p.flag <= 16 AND q.flag > 16 AND q.cm >= 300)", _EACH).replace("CASE WHEN q.start > p.start THEN p ELSE q END AS l, CASE WHEN q.start > p.start THEN q ELSE p END AS r", "p AS l, q AS r"))
def split_all_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Signals of all pairs of a contig's pieces, each pair once."""
    return alignments.split_signals(alignments.banded_pairs(short_pieces(spark, sf_dir, once=False), kind="same"), exact_mapq=60).drop("svid", "seq")


@query(SHORT.split(",\nz AS (")[0].replace("FROM p JOIN p q ON p.qname = q.qname AND p.flag <= 16 AND q.flag > 16 AND q.cm >= 300)", "FROM p JOIN p q ON p.qname = q.qname AND p.chrom < q.chrom AND (p.cm >= 250 OR q.cm >= 250))") + """,
t AS (SELECT qname, p.chrom AS a, q.chrom AS b,
 CASE WHEN abs(p.cl - q.cl - q.cm) <= 500 OR abs(p.cl - q.cm - q.cr) <= 500 THEN p.start WHEN abs(p.cr - q.cl - q.cm) <= 500 OR abs(p.cr - q.cm - q.cr) <= 500 THEN p.stop END AS x,
 CASE WHEN abs(q.cl - p.cl - p.cm) <= 500 OR abs(q.cl - p.cm - p.cr) <= 500 THEN q.start WHEN abs(q.cr - p.cl - p.cm) <= 500 OR abs(q.cr - p.cm - p.cr) <= 500 THEN q.stop END AS y
 FROM pq WHERE floor((p.mapq + q.mapq) / 2) = 60)
SELECT a AS chrom, qname AS query_name, x AS start, b AS chrom2, y AS start2 FROM t WHERE x IS NOT NULL AND y IS NOT NULL""")
def split_all_translocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    order = spark.createDataFrame([("Chr1", 1), ("Chr2", 2)], "chrom string, rank int")
    return alignments.translocation_signals(alignments.banded_pairs(short_pieces(spark, sf_dir, once=False), kind="other"), order).select("chrom", "query_name", "start", "chrom2", "start2")


def ratios(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark_table(spark, sf_dir, "ratio")


@query(cte("ratio") + """ SELECT k1, k2, k3, k4, CASE WHEN depth = 0 THEN './.' WHEN depth <= 5 THEN CASE WHEN floor(0.75 * depth) + 1 <= support THEN '1/1' WHEN support / depth <= 0.2 THEN '0/0' ELSE '0/1' END
 WHEN depth <= 10 THEN CASE WHEN 0.75 * depth + 1 <= support THEN '1/1' WHEN 0.05 * depth + 1 > support THEN '0/0' ELSE '0/1' END ELSE CASE WHEN support / depth >= 0.75 THEN '1/1' WHEN support / depth < 0.05 THEN '0/0' ELSE '0/1' END END AS lr,
 CASE WHEN a >= 0.65 THEN '1/1' WHEN a < 0.1 THEN '0/0' ELSE '0/1' END AS sr FROM ratio""")
def gt_ratio_ladder(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ratios(spark, sf_dir).select(*K, genotypes.by_depth(F.col("support"), F.col("depth")).alias("lr"), genotypes.by_ratio(F.col("a")).alias("sr"))


TWO = {
    "lr_dup": ("(a >= 0.4 AND b >= 0.4) OR a + b >= 0.9", "a + b < 0.1"), "lr_inv": ("greatest(a, b) >= 0.85", "a + b < 0.1"),
    "lr_tra_names": ("greatest(a, b) > 0.9 OR (a >= 0.8 AND b >= 0.8)", "a + b < 0.1"), "lr_tra": ("greatest(a, b) >= 0.9 OR (a >= 0.85 AND b >= 0.85)", "a + b < 0.1"),
    "sr_dup": ("(a >= 0.25 AND b >= 0.25) OR (greatest(a, b) >= 0.3 AND least(a, b) >= 0.1)", "greatest(a, b) < 0.05"), "sr_inv": ("(a >= 0.6 AND b >= 0.6) OR (greatest(a, b) >= 0.75 AND least(a, b) >= 0.3)", "greatest(a, b) < 0.05"),
    "sr_tra": ("(a >= 0.6 AND b >= 0.6) OR (greatest(a, b) >= 0.75 AND least(a, b) >= 0.3)", "greatest(a, b) < 0.05"), "sr_breaks": ("greatest(a, b) > 0.75 AND least(a, b) > 0.4", "greatest(a, b) < 0.2 OR least(a, b) < 0.1"),
    "cr_dup": ("greatest(a, b) > 0.6", "greatest(a, b) < 0.2"), "cr_inv": ("greatest(a, b) > 0.7 AND least(a, b) >= 0.55", "greatest(a, b) < 0.3 OR least(a, b) < 0.15"), "force_inv": ("greatest(a, b) >= 0.8", "a + b < 0.1"),
}


@query(cte("ratio") + " SELECT k1, k2, k3, k4, " + ", ".join(f"CASE WHEN {h} THEN '1/1' WHEN {r} THEN '0/0' ELSE '0/1' END AS {n}" for n, (h, r) in TWO.items()) + " FROM ratio")
def gt_two_breakpoint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ratios(spark, sf_dir).select(*K, *[genotypes.by_two(F.col("a"), F.col("b"), n).alias(n) for n in TWO])


ONE = {"lr_dup_small": "a > 0.75|0.05", "lr_dup_sa": "a >= 0.625|0.1", "cr": "a > 0.65|0.15", "cr_sa": "a >= 0.6|0.2", "force_sa": "a >= 0.6|0.05", "signal": "a > 0.65|0.1"}


@query(cte("ratio") + " SELECT k1, k2, k3, k4, " + ", ".join(f"CASE WHEN {v.split('|')[0]} THEN '1/1' WHEN a < {v.split('|')[1]} THEN '0/0' ELSE '0/1' END AS {n}" for n, v in ONE.items()) + " FROM ratio")
def gt_one_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ratios(spark, sf_dir).select(*K, *[genotypes.by_one(F.col("a"), n).alias(n) for n in ONE])


LADDER = "CASE WHEN {d} = 0 THEN './.' WHEN {d} <= 5 THEN CASE WHEN floor(0.75 * {d}) + 1 <= {s} THEN '1/1' WHEN {s} / {d} <= 0.2 THEN '0/0' ELSE '0/1' END WHEN {d} <= 10 THEN CASE WHEN 0.75 * {d} + 1 <= {s} THEN '1/1' WHEN 0.05 * {d} + 1 > {s} THEN '0/0' ELSE '0/1' END ELSE CASE WHEN {s} / {d} >= 0.75 THEN '1/1' WHEN {s} / {d} < 0.05 THEN '0/0' ELSE '0/1' END END"


@query(cte("ratio") + f""", x AS (SELECT *, support % 3 AS ev, support % 5 AS cl, support % 4 AS ev2, spans AS cl2, depth + spans AS depth2 FROM ratio),
i AS (SELECT *, {LADDER.format(s="(ev + cl)", d="depth")} AS i1, {LADDER.format(s="greatest(ev + cl, ev2 + cl2)", d="(CASE WHEN ev + cl > ev2 + cl2 THEN depth ELSE depth2 END)")} AS d1 FROM x),
j AS (SELECT *, CASE WHEN i1 = '1/1' AND floor(0.08 * depth) + 1 <= spans THEN '0/1' ELSE i1 END AS i2 FROM i)
SELECT k1, k2, k3, k4, CASE WHEN depth > 0 AND i2 <> '0/0' AND size < 800 AND ev = 0 THEN '0/0' ELSE i2 END AS ins, CASE WHEN depth + depth2 = 0 THEN './.' WHEN d1 <> '0/0' AND size < 1000 AND ev + ev2 = 0 THEN '0/0' ELSE d1 END AS del FROM j""")
def gt_long_reads(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = ratios(spark, sf_dir).withColumns({"ev": F.col("support") % 3, "cl": F.col("support") % 5, "ev2": F.col("support") % 4, "depth2": F.col("depth") + F.col("spans")})
    c = F.col
    return x.select(*K, genotypes.insertion(c("ev"), c("cl"), c("depth"), c("spans"), c("size")).alias("ins"), genotypes.deletion(c("ev"), c("cl"), c("depth"), c("ev2"), c("spans"), c("depth2"), c("size")).alias("del"))


@query(cte("ratio") + """, g AS (SELECT *, CASE WHEN a >= 0.65 THEN '1/1' WHEN a < 0.1 THEN '0/0' ELSE '0/1' END AS g FROM ratio)
SELECT k1, k2, k3, k4, CASE WHEN depth = 0 THEN './.' WHEN g = '0/1' AND spans <= 0.01 * depth + 1 THEN '1/1' WHEN g = '1/1' AND spans >= 0.05 * depth + 1 THEN '0/1' ELSE g END AS ins,
CASE WHEN depth = 0 OR support % 7 >= 2 THEN '1/1' WHEN spans = 0 THEN '1/1' WHEN g = '1/1' AND spans >= 0.3 * depth + 2 THEN '0/1' ELSE g END AS del FROM g""")
def gt_short_reads(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = F.col
    return ratios(spark, sf_dir).select(*K, genotypes.short_insertion(c("a"), c("depth"), c("spans")).alias("ins"), genotypes.short_deletion(c("a"), c("depth"), c("spans"), c("support") % 7).alias("del"))


@query(cte("sig") + """ SELECT chrom, start, stop, CASE WHEN sv_type IN ('DEL', 'INV') THEN sv_len WHEN sv_type IN ('INS', 'DUP') THEN -sv_len ELSE 0 END AS target_size, CASE WHEN sv_type = 'DEL' THEN -sv_len ELSE sv_len END AS query_size, sv_type, 's1' AS sample,
CASE WHEN sv_rate > 0.65 THEN '1/1' WHEN sv_rate < 0.1 THEN '0/0' ELSE '0/1' END AS gt, CAST(ceil(cluster_size / sv_rate) AS BIGINT) AS reads, half_even(sv_rate, 2) AS ratio FROM sig""")
def gt_signal_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return genotypes.from_signal_rate(sig(spark, sf_dir), "s1")


@query(cte("name") + """, a AS (SELECT vid, qname, count(*) AS n FROM name WHERE side = 0 GROUP BY ALL), b AS (SELECT vid, qname, count(*) AS n FROM name WHERE side = 1 GROUP BY ALL),
f AS (SELECT coalesce(a.vid, b.vid) AS vid, a.n AS x, b.n AS y FROM a FULL JOIN b ON a.vid = b.vid AND a.qname = b.qname),
s AS (SELECT vid, CAST(sum(CASE WHEN x IS NOT NULL AND y IS NOT NULL THEN 1 ELSE 0 END) AS BIGINT) AS shared, CAST(coalesce(sum(x), 0) AS BIGINT) AS reads_a, CAST(coalesce(sum(y), 0) AS BIGINT) AS reads_b FROM f GROUP BY vid),
r AS (SELECT *, CASE WHEN reads_a > 0 THEN half_even(shared / reads_a, 3) ELSE 0 END AS a, CASE WHEN reads_b > 0 THEN half_even(shared / reads_b, 3) ELSE 0 END AS b FROM s)
SELECT vid, shared, reads_a, reads_b, CASE WHEN greatest(a, b) > 0.9 OR least(a, b) >= 0.8 THEN '1/1' WHEN a + b < 0.1 THEN '0/0' ELSE '0/1' END AS gt FROM r""")
def tra_shared_reads(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark_table(spark, sf_dir, "name")
    sides = [rows.where(F.col("side") == k).select("vid", "qname") for k in (0, 1)]
    counts = genotypes.shared_names(*sides, ["vid"])
    return counts.withColumn("gt", genotypes.by_two(genotypes.share(F.col("shared"), F.col("reads_a")), genotypes.share(F.col("shared"), F.col("reads_b")), "lr_tra_names"))


SAMPLES = [f"s{k}" for k in range(10, 18)]


def calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark_table(spark, sf_dir, "gt")


@query(cte("gt") + " SELECT id, arg_min(chrom, (sample, event_id)) AS chrom, arg_min(pos, sample) AS pos, " + ", ".join(f"coalesce(max(CASE WHEN sample = '{s}' THEN gt END), './.') AS {s}" for s in SAMPLES) + " FROM gt GROUP BY id")
def cohort_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cohort.cohort_matrix(calls(spark, sf_dir), SAMPLES)


ONCE = cte("gt") + ", c AS (SELECT id, chrom, pos, sample, max(gt) AS gt FROM gt GROUP BY ALL)"


def once(spark: SparkSession, sf_dir: str) -> DataFrame:
    return calls(spark, sf_dir).groupBy("id", "chrom", "pos", "sample").agg(F.max("gt").alias("gt"))


@query(ONCE + """, h AS (SELECT coalesce(a.id, b.id) AS id, coalesce(a.gt, './.') AS x, coalesce(b.gt, './.') AS y FROM (SELECT * FROM c WHERE sample = 's10') a FULL JOIN (SELECT * FROM c WHERE sample = 's11') b ON a.id = b.id),
m AS (SELECT id, CASE x WHEN '1/1' THEN '1' WHEN '0/0' THEN '0' WHEN './.' THEN '.' ELSE x END || '|' || CASE y WHEN '1/1' THEN '1' WHEN '0/0' THEN '0' WHEN './.' THEN '.' ELSE y END AS p FROM h)
SELECT id, CASE p WHEN '0/1|1' THEN '0|1' WHEN '0/1|0' THEN '1|0' WHEN '0|0/1' THEN '0|1' WHEN '1|0/1' THEN '1|0' WHEN '0/1|0/1' THEN '0/1' ELSE p END AS gt FROM m""")
def phase_diploid(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = once(spark, sf_dir)
    return cohort.phase_two(rows.where("sample = 's10'"), rows.where("sample = 's11'"), ["id"])


@query(ONCE + """, p AS (SELECT id, string_agg(CASE gt WHEN '1/1' THEN '1' WHEN './.' THEN '.' ELSE '0' END, '|' ORDER BY sample) AS phased FROM c GROUP BY id)
SELECT id, phased, CASE WHEN contains(phased, '0') AND contains(phased, '1') THEN '0/1' WHEN contains(phased, '1') THEN '1/1' WHEN contains(phased, '0') AND contains(phased, '.') THEN './0' WHEN NOT contains(phased, '.') THEN '0/0' ELSE '.' END AS gt FROM p""")
def phase_polyploid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cohort.phase_many(once(spark, sf_dir).withColumn("hap", F.col("sample")), ["id"])


@query("""WITH a AS (SELECT id, gt, row_number() OVER (ORDER BY chrom, pos, id) AS place FROM x WHERE sample = 's10'), b AS (SELECT gt, row_number() OVER (ORDER BY chrom, pos, id) AS place FROM x WHERE sample = 's11'),
h AS (SELECT coalesce(a.place, b.place) AS place, a.id, coalesce(a.gt, './.') AS x, coalesce(b.gt, './.') AS y FROM a FULL JOIN b ON a.place = b.place),
m AS (SELECT place, id, CASE x WHEN '1/1' THEN '1' WHEN '0/0' THEN '0' WHEN './.' THEN '.' ELSE x END || '|' || CASE y WHEN '1/1' THEN '1' WHEN '0/0' THEN '0' WHEN './.' THEN '.' ELSE y END AS p FROM h)
SELECT place, id, CASE p WHEN '0/1|1' THEN '0|1' WHEN '0/1|0' THEN '1|0' WHEN '0|0/1' THEN '0|1' WHEN '1|0/1' THEN '1|0' WHEN '0/1|0/1' THEN '0/1' ELSE p END AS gt FROM m""".replace("WITH a", ONCE + ", x AS (SELECT * FROM c), a", 1))
def phase_positional(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = once(spark, sf_dir)
    return cohort.phase_positional(rows.where("sample = 's10'"), rows.where("sample = 's11'"), ["chrom", "pos", "id"], ["id"])


def _sample_places(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(s, k + 1) for k, s in enumerate([*SAMPLES, "s99"])], "sample string, place int")


@query(cte("gt") + " SELECT id, arg_min(chrom, sample) AS chrom, arg_min(pos, sample) AS pos, concat_ws(',', " + ", ".join(f"coalesce(max(CASE WHEN sample = '{s}' THEN gt END), './.')" for s in [*SAMPLES, "s99"]) + ") AS calls FROM gt GROUP BY id")
def cohort_arrays(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cohort's calls as one array a variant, over nine samples of which one has no calls."""
    return cohort.cohort_arrays(calls(spark, sf_dir), _sample_places(spark)).withColumn("calls", F.array_join("calls", ","))


@query(ONCE + " SELECT id, coalesce(string_agg(CAST(CAST(substr(sample, 2) AS INT) - 9 AS VARCHAR) || ':' || gt, ',' ORDER BY sample) FILTER (WHERE gt <> '0/0'), '') AS calls FROM c GROUP BY id")
def cohort_sparse(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = cohort.cohort_arrays(calls(spark, sf_dir), _sample_places(spark), usual="0/0", sparse=True)
    return found.select("id", F.array_join(F.transform("calls", lambda x: F.concat_ws(":", x["place"], x["gt"])), ",").alias("calls"))


@query(None)
def impute_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Missing calls from clusters of haplotypes; tests compare it with a plain hierarchical clustering."""
    rows = once(spark, sf_dir).groupBy("id", "chrom", "sample", "pos").agg(F.max("gt").alias("gt"))
    return cohort.impute_clusters(rows, ["id"], ["pos", "id"], 4, 2, ("chrom",), block=16).select("id", "sample", "gt", "imputed")


def _impute(exclude: bool) -> str:
    around = "list_filter(w, lambda x: x.at <> rn)" if exclude else "w"
    return ONCE + f""", d AS (SELECT id, sample, pos, max(gt) AS gt FROM c GROUP BY ALL), g AS (SELECT *, row_number() OVER (PARTITION BY sample ORDER BY pos, id) AS rn FROM d),
w AS (SELECT *, list({{'at': rn, 'gt': gt}}) OVER (PARTITION BY sample ORDER BY pos, id ROWS BETWEEN 2 PRECEDING AND 2 FOLLOWING) AS w FROM g), p AS (SELECT *, array_to_string(list_transform({around}, lambda x: x.gt), ',') AS pattern FROM w),
o AS (SELECT id, pattern, arg_min(gt, sample) AS donor FROM p WHERE gt <> './.' GROUP BY ALL)
SELECT p.id, p.sample, p.gt, CASE WHEN p.gt <> './.' THEN p.gt ELSE coalesce(o.donor, './.') END AS imputed FROM p LEFT JOIN o ON p.id = o.id AND p.pattern = o.pattern"""


def _imputed(spark: SparkSession, sf_dir: str, exclude: bool) -> DataFrame:
    rows = once(spark, sf_dir).groupBy("id", "sample", "pos").agg(F.max("gt").alias("gt"))
    return cohort.impute(rows, ["id"], ["pos", "id"], 2, exclude).select("id", "sample", "gt", "imputed")


@query(_impute(True))
def impute_neighbour(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _imputed(spark, sf_dir, True)


@query(_impute(False))
def impute_identity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _imputed(spark, sf_dir, False)


@query(cte("gt") + " SELECT id, avg(CASE WHEN gt = '1/1' THEN 1.0 ELSE 0.0 END) AS maf, count(*) AS n FROM gt GROUP BY id HAVING avg(CASE WHEN gt = '1/1' THEN 1.0 ELSE 0.0 END) BETWEEN 0.05 AND 0.5")
def maf_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cohort.homozygous_frequency(calls(spark, sf_dir), ["id"]).where(F.col("maf").between(0.05, 0.5))


@query(cte("gt") + ", m AS (SELECT id, " + ", ".join(f"coalesce(max(CASE WHEN sample = '{s}' THEN gt END), './.') AS {s}" for s in SAMPLES) + " FROM gt GROUP BY id) SELECT id, (" + " + ".join(f"CASE WHEN {s} = './.' THEN 1 ELSE 0 END" for s in SAMPLES) + ") / 13 AS rate FROM m")
def missing_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    matrix = cohort.cohort_matrix(calls(spark, sf_dir), SAMPLES)
    return matrix.select("id", cohort.missing_rate([F.col(s) for s in SAMPLES], 5).alias("rate"))


PARTS = cte("sig", "gene") + """, cds AS (SELECT gene, chrom, strand, start AS g0, stop AS g1, start + 100 + i * 400 AS start, start + 250 + i * 400 + (start // 2000) % 3 AS stop FROM (SELECT *, unnest(range(0, 1 + (start // 2000) % 4)) AS i FROM gene)),
k AS (SELECT *, row_number() OVER (PARTITION BY gene ORDER BY start) AS k, count(*) OVER (PARTITION BY gene) AS n, lead(start) OVER (PARTITION BY gene ORDER BY start) AS nx FROM cds),
parts AS (SELECT gene, chrom, concat('cds', CASE WHEN strand = '-' THEN n - k + 1 ELSE k END) AS part, start, stop FROM k
 UNION ALL SELECT gene, chrom, concat('intron', CASE WHEN strand = '-' THEN n - 1 - k + 1 ELSE k END), stop + 1, nx - 1 FROM k WHERE nx IS NOT NULL AND stop + 1 <= nx - 1
 UNION ALL SELECT gene, chrom, CASE WHEN strand = '+' THEN 'utr5' ELSE 'utr3' END, g0, min(start) FROM k GROUP BY gene, chrom, strand, g0, g1 HAVING g0 < min(start)
 UNION ALL SELECT gene, chrom, CASE WHEN strand = '+' THEN 'utr3' ELSE 'utr5' END, max(stop), g1 FROM k GROUP BY gene, chrom, strand, g0, g1 HAVING max(stop) < g1)"""


def gene_tables(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    genes = spark_table(spark, sf_dir, "gene")
    number = F.expr("start div 2000")
    coded = genes.select("gene", "start", number.alias("g"), F.explode(F.sequence(F.lit(0).cast("long"), number % 4)).alias("i"))
    return genes, coded.select("gene", (F.col("start") + 100 + F.col("i") * 400).alias("start"), (F.col("start") + 250 + F.col("i") * 400 + F.col("g") % 3).alias("stop"))


@query(PARTS + " SELECT * FROM parts")
def gene_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return annotation.gene_parts(*gene_tables(spark, sf_dir))


@query(PARTS + """, h AS (SELECT s.svid, p.gene, p.part, s.start AS s, s.stop AS e, p.start AS a, p.stop AS b FROM sig s JOIN parts p ON s.chrom = p.chrom AND s.sv_type = 'DEL' AND s.stop - s.start > 40 AND p.start < p.stop AND p.start < s.stop AND p.stop > s.start),
c AS (SELECT *, CASE WHEN s <= a AND e >= b THEN 'all' WHEN s < a AND e <= b AND e > a THEN 'left' WHEN s > a AND s < b AND e > b THEN 'right' WHEN s >= a AND e <= b THEN 'center' END AS lost FROM h),
d AS (SELECT *, CASE lost WHEN 'all' THEN b - a + 1 WHEN 'left' THEN e - a + 1 WHEN 'right' THEN b - s + 1 ELSE e - s + 1 END AS bases FROM c WHERE lost IS NOT NULL)
SELECT svid, gene, part, lost, bases, CASE WHEN part LIKE 'cds%' THEN CASE WHEN lost = 'all' OR bases % 3 = 0 THEN 'AS' ELSE 'frameshift' END WHEN part LIKE 'utr%' THEN 'Exp' WHEN lost = 'all' THEN 'intron_lost' ELSE 'intron_smaller' END AS impact FROM d""")
def del_impact(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = annotation.gene_parts(*gene_tables(spark, sf_dir))
    return annotation.deletion_impact(sig(spark, sf_dir), parts).select("svid", F.col("r_gene").alias("gene"), F.col("r_part").alias("part"), "lost", "bases", "impact")


@query(PARTS + """, h AS (SELECT s.svid, p.gene, p.part, CASE WHEN part LIKE 'cds%' THEN CASE WHEN sv_len % 3 = 0 THEN 'AS' ELSE 'frameshift' END WHEN part LIKE 'utr%' THEN 'Exp' ELSE 'intron_exten' END AS impact FROM sig s JOIN parts p ON s.chrom = p.chrom AND s.sv_type = 'INS' AND p.start < p.stop AND p.start < s.stop AND p.stop > s.start)
SELECT svid, string_agg(DISTINCT concat(gene, '__', part, ':', impact), ', ' ORDER BY concat(gene, '__', part, ':', impact)) AS struc FROM h GROUP BY svid""")
def ins_impact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return annotation.impact_text(annotation.insertion_impact(sig(spark, sf_dir), annotation.gene_parts(*gene_tables(spark, sf_dir))), ["svid"])


@query(PARTS + """, place AS (SELECT gene, chrom, 'gene' AS part, start, stop FROM gene UNION ALL SELECT gene, chrom, 'CDS', start, stop FROM cds
 UNION ALL SELECT gene, chrom, '3k_promoter', greatest(CASE WHEN strand = '+' THEN start - 3000 ELSE stop + 1 END, 1), CASE WHEN strand = '+' THEN start - 1 ELSE stop + 3000 END FROM gene),
h AS (SELECT s.svid, p.part, concat(p.gene, ':', CASE WHEN p.part = 'gene' AND s.start <= p.start AND s.stop >= p.stop THEN 'GenePAV' ELSE p.part END) AS label FROM sig s JOIN place p ON s.chrom = p.chrom AND p.start < p.stop AND p.start < s.stop AND p.stop > s.start)
SELECT svid, coalesce(string_agg(DISTINCT CASE WHEN part = 'gene' THEN label END, ',' ORDER BY CASE WHEN part = 'gene' THEN label END), '') AS genes, coalesce(string_agg(DISTINCT CASE WHEN part = 'CDS' THEN label END, ',' ORDER BY CASE WHEN part = 'CDS' THEN label END), '') AS cds,
coalesce(string_agg(DISTINCT CASE WHEN part = '3k_promoter' THEN label END, ',' ORDER BY CASE WHEN part = '3k_promoter' THEN label END), '') AS promoters FROM h GROUP BY svid""")
def promoter_hit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return annotation.position_annotation(sig(spark, sf_dir), *gene_tables(spark, sf_dir), ["svid"])


@query(cte("sig", "gene") + " SELECT s.svid, g.gene FROM sig s JOIN gene g ON s.chrom = g.chrom AND s.start <= g.stop AND s.stop >= g.start")
def gene_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    return intervals.overlap_join(sig(spark, sf_dir), spark_table(spark, sf_dir, "gene")).select("svid", F.col("r_gene").alias("gene"))


def _nested(kinds: list[tuple[str, str]], gap: int, near: int = 0) -> str:
    order = "start, sv_len, k1, k2, k3, k4"
    allowed = ", ".join(f"'{a}{b}'" for a, b in kinds)
    longer = "AND o.sv_len > i.sv_len" if near else ""
    return cte("sig") + f""", v AS (SELECT chrom, start, stop, sv_len, sv_type, k1, k2, k3, k4 FROM sig), l AS (SELECT *, lag(stop) OVER w AS pe FROM v WINDOW w AS (PARTITION BY chrom ORDER BY {order})),
i AS (SELECT *, CAST(sum(CASE WHEN pe IS NOT NULL AND start <= pe + {gap} THEN 0 ELSE 1 END) OVER (PARTITION BY chrom ORDER BY {order} ROWS UNBOUNDED PRECEDING) AS BIGINT) AS cluster FROM l),
p AS (SELECT o.chrom, o.cluster, o.start AS o_start, o.stop AS o_stop, o.sv_type AS o_sv_type, o.sv_len AS o_sv_len, i.start AS i_start, i.stop AS i_stop, i.sv_type AS i_sv_type, i.sv_len AS i_sv_len, o.k1 AS a1, o.k2 AS a2, o.k3 AS a3, o.k4 AS a4, i.k1 AS b1, i.k2 AS b2, i.k3 AS b3, i.k4 AS b4
 FROM i o JOIN i ON o.chrom = i.chrom AND o.cluster = i.cluster AND i.start >= o.start - {near} AND i.stop <= o.stop + {near} AND (o.k1, o.k2, o.k3, o.k4) <> (i.k1, i.k2, i.k3, i.k4) {longer}
 AND concat(o.sv_type, i.sv_type) IN ({allowed}))
SELECT chrom, cluster, CAST(floor(quantile_cont(o_start, 0.5)) AS BIGINT) AS o_start, CAST(floor(quantile_cont(o_stop, 0.5)) AS BIGINT) AS o_stop, CAST(floor(quantile_cont(i_start, 0.5)) AS BIGINT) AS i_start, CAST(floor(quantile_cont(i_stop, 0.5)) AS BIGINT) AS i_stop,
arg_min(o_sv_type, z) AS o_sv_type, arg_min(o_sv_len, z) AS o_sv_len, arg_min(i_sv_type, z) AS i_sv_type, arg_min(i_sv_len, z) AS i_sv_len, count(*) AS pairs FROM (SELECT *, (o_start, o_sv_len, a1, a2, a3, a4, i_start, i_sv_len, b1, b2, b3, b4) AS z FROM p) GROUP BY chrom, cluster"""


def nested_by(spark: SparkSession, sf_dir: str, form: str, gap: int, near: int = 0) -> DataFrame:
    rows = sig(spark, sf_dir).select("chrom", "start", "stop", "sv_len", "sv_type", *K)
    return nested.nested_pairs(rows, ["sv_len", *K], form, gap, near, lambda pairs, by: nested.nested_consensus(pairs, ["sv_len", *K], by))


@query(_nested([("DUP", "INV"), ("DUP", "DEL"), ("INS", "INV"), ("INS", "DEL"), ("INV", "INS"), ("INV", "DEL"), ("INV", "DUP")], 500))
def nested_sv(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nested_by(spark, sf_dir, "genome", 500)


@query(_nested([("DUP", "INV"), ("DUP", "DEL"), ("INV", "INS"), ("INV", "DEL"), ("INV", "DUP")], 400))
def nested_sv_cohort(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nested_by(spark, sf_dir, "cohort", 400)


@query(_nested([("DUP", "INV"), ("DUP", "DEL"), ("DUP", "INS"), ("INV", "INS"), ("INV", "DEL"), ("INV", "DUP"), ("INS", "INV"), ("INS", "DEL")], 500, 100))
def nested_sv_near(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nested_by(spark, sf_dir, "near", 500, 100)


MIRROR = cte("sig") + ", inv AS (SELECT DISTINCT chrom, start AS a, stop + 4000 AS b FROM sig WHERE sv_type = 'INV')"


@query(MIRROR + """, h AS (SELECT s.svid, max((inv.a, inv.b)) AS m FROM sig s JOIN inv ON s.sv_type <> 'INV' AND s.chrom = inv.chrom AND s.start >= inv.a - 10 AND s.start <= inv.b + 10 GROUP BY s.svid),
t AS (SELECT s.svid, s.start, s.stop, struct_extract_at(m, 1) + struct_extract_at(m, 2) AS t FROM sig s LEFT JOIN h ON s.svid = h.svid WHERE s.sv_type <> 'INV')
SELECT svid, CASE WHEN t IS NULL THEN start ELSE least(t - start, t - stop) END AS start, CASE WHEN t IS NULL THEN stop ELSE greatest(t - start, t - stop) END AS stop, t IS NOT NULL AS mirrored FROM t""")
def mirror_coords(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = sig(spark, sf_dir)
    inv = rows.where("sv_type = 'INV'").select("chrom", "start", (F.col("stop") + 4000).alias("stop")).distinct()
    return nested.mirror(rows.where("sv_type <> 'INV'"), inv, ["svid"]).select("svid", "start", "stop", "mirrored")


@query(cte("dna") + " SELECT doc_id, reverse(translate(seq, 'ACGTacgt', 'TGCAtgca')) AS rc, regexp_full_match(seq, '[ACGTN]*') AS dna, CAST((length(seq) - length(replace(seq, 'GATC', ''))) / 4 AS INT) AS sites FROM dna")
def revcomp(spark: SparkSession, sf_dir: str) -> DataFrame:
    seq = F.col("seq")
    return spark_table(spark, sf_dir, "dna").select("doc_id", scalars.reverse_complement(seq).alias("rc"), scalars.is_dna(seq).alias("dna"), scalars.occurrences(seq, F.lit("GATC")).alias("sites"))


@query(cte("sig", "inv") + """, n AS (SELECT chrom, start AS a, stop AS b, row_number() OVER (PARTITION BY chrom ORDER BY start, stop) AS k FROM (SELECT DISTINCT * FROM inv)),
f AS (SELECT svid, chrom, start, stop, CAST(0 AS BIGINT) AS k FROM sig UNION ALL SELECT svid, f.chrom, CASE WHEN start >= a AND stop <= b THEN least(a + b - start, a + b - stop) ELSE start END, CASE WHEN start >= a AND stop <= b THEN greatest(a + b - start, a + b - stop) ELSE stop END, n.k FROM f JOIN n ON f.chrom = n.chrom AND n.k = f.k + 1)
SELECT svid, max_by(start, k) AS start, max_by(stop, k) AS stop FROM f GROUP BY svid""")
def mirror_contained(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = sig(spark, sf_dir).select("svid", "chrom", "start", "stop")
    return nested.mirror_contained(rows, spark_table(spark, sf_dir, "inv"), ["svid"]).select("svid", "start", "stop")


_TURN = "substr({s}, 1, {a}) || reverse(translate(substr({s}, {a} + 1, {b} - {a}), 'ACGT', 'TGCA')) || substr({s}, {b} + 1)"


@query(cte("dna") + ", e AS (SELECT doc_id, seq, CAST(doc_id % 50 AS INT) AS a1, CAST(doc_id % 50 + 300 AS INT) AS b1, CAST(doc_id % 90 + 60 AS INT) AS a2, CAST(doc_id % 90 + 700 AS INT) AS b2 FROM dna), f AS (SELECT *, "
       + _TURN.format(s="seq", a="a2", b="b2") + " AS late FROM e) SELECT doc_id, md5(" + _TURN.format(s="late", a="a1", b="b1") + ") AS turned FROM f")
def inverted_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark_table(spark, sf_dir, "dna").withColumn("chrom", F.col("doc_id").cast("string"))
    at = F.col("doc_id")
    places = F.array(F.struct((at % 50).alias("start"), (at % 50 + 300).alias("stop")), F.struct((at % 90 + 60).alias("start"), (at % 90 + 700).alias("stop")))
    found = rows.select("chrom", F.explode(places).alias("p")).select("chrom", "p.*")
    return nested.invert_sequences(rows, found).select("doc_id", F.md5("seq").alias("turned"))


#: Chunks of a thousand letters, so that slices cross many.
SMALL = 1000


def dna_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    whole = spark_table(spark, sf_dir, "dna").select(F.col("doc_id").cast("string").alias("chrom"), "seq")
    return sequences.chunked(whole, SMALL)


@query(cte("dna", "inv") + """, r AS (SELECT doc_id, k, (doc_id * 37 + k * 811) % 9000 AS a, (doc_id * 37 + k * 811) % 9000 + (doc_id * 13 + k * 4001) % 6000 AS b, (doc_id + k) % 2 = 1 AS turned FROM dna, range(0, 4) q(k) WHERE length(seq) > 0)
SELECT doc_id, k, a AS start, b AS stop, md5(CASE WHEN b <= a THEN '' WHEN turned THEN reverse(translate(substr(seq, a + 1, b - a), 'ACGT', 'TGCA')) ELSE substr(seq, a + 1, b - a) END) AS slice FROM r JOIN dna USING (doc_id) WHERE b <= a OR a < length(seq)""")
def seq_slices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Slices of chunked sequences on both strands, across chunks and beyond the ends."""
    rows = spark_table(spark, sf_dir, "dna").where(F.length("seq") > 0).select("doc_id", F.col("doc_id").cast("string").alias("chrom"), F.explode(F.sequence(F.lit(0).cast("long"), F.lit(3).cast("long"))).alias("k"))
    at = (F.col("doc_id") * 37 + F.col("k") * 811) % 9000
    asked = rows.withColumns({"start": at, "stop": at + (F.col("doc_id") * 13 + F.col("k") * 4001) % 6000, "turned": (F.col("doc_id") + F.col("k")) % 2 == 1})
    found = sequences.slices(dna_chunks(spark, sf_dir), asked, ["doc_id", "k"], SMALL, "turned", "slice")
    return found.where("slice is not null").select("doc_id", "k", "start", "stop", F.md5("slice").alias("slice"))


@query(cte("dna") + ", e AS (SELECT doc_id, seq, 700 + CAST(doc_id % 50 AS INT) AS a1, 3300 + CAST(doc_id % 50 AS INT) AS b1, 1500 + CAST(doc_id % 90 AS INT) AS a2, 5200 + CAST(doc_id % 90 AS INT) AS b2 FROM dna WHERE length(seq) > 0), f AS (SELECT *, "
       + _TURN.format(s="seq", a="a2", b="b2") + " AS late FROM e), g AS (SELECT doc_id, " + _TURN.format(s="late", a="a1", b="b1") + " AS t FROM f), h AS (SELECT doc_id, t, unnest(range(0, (length(t) + 999) // 1000)) AS chunk FROM g) SELECT doc_id, chunk, md5(substr(t, chunk * 1000 + 1, 1000)) AS text FROM h")
def seq_inverted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Overlapping inversions of chunked sequences, chunk by chunk."""
    at = F.col("doc_id")
    places = F.array(F.struct((at % 50 + 700).alias("start"), (at % 50 + 3300).alias("stop")), F.struct((at % 90 + 1500).alias("start"), (at % 90 + 5200).alias("stop")))
    found = spark_table(spark, sf_dir, "dna").select(F.col("doc_id").cast("string").alias("chrom"), F.explode(places).alias("p")).select("chrom", "p.*")
    return sequences.inverted(dna_chunks(spark, sf_dir), found, SMALL).select(F.col("chrom").cast("long").alias("doc_id"), "chunk", F.md5("text").alias("text"))


MOTIF, SPAN = "TTGCA", 64


@query(cte("dna") + f""", f AS (SELECT doc_id, 1 AS round, seq, strpos(seq, '{MOTIF}') AS p FROM dna WHERE length(seq) > 0
 UNION ALL SELECT doc_id, round + 1, t, strpos(t, '{MOTIF}') FROM (SELECT doc_id, round, substr(seq, 1, p - 1) || reverse(translate(substr(seq, p, {SPAN}), 'ACGT', 'TGCA')) || substr(seq, p + {SPAN}) AS t FROM f WHERE p > 0 AND round < 6)),
n AS (SELECT round, count(*) FILTER (WHERE p > 0) AS n FROM f GROUP BY round), l AS (SELECT round, n = 0 OR coalesce(n >= lag(n) OVER (ORDER BY round), false) AS ends FROM n)
SELECT doc_id, round, p - 1 AS start, p - 1 + {SPAN} AS stop FROM f WHERE p > 0 AND round <= coalesce((SELECT min(round) FROM l WHERE ends), 6)""")
def inversion_rounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rounds of calling and inverting chunked sequences until there are no fewer inversions than before: the first place of a motif is
    called, so each round turns one and may make another."""

    def call(store: DataFrame) -> DataFrame:
        # a chunk with the next one's first letters shows every place of the motif that begins in it
        by = Window.partitionBy("chrom").orderBy("chunk")
        seen = store.withColumn("wide", F.concat("text", F.coalesce(F.substring(F.lead("text").over(by), 1, len(MOTIF) - 1), F.lit(""))))
        at = seen.select("chrom", F.when(F.instr("wide", MOTIF) > 0, F.col("chunk") * SMALL + F.instr("wide", MOTIF) - 1).alias("start")).groupBy("chrom").agg(F.min("start").alias("start")).where("start is not null")
        return at.select("chrom", "start", (F.col("start") + SPAN).alias("stop"), F.lit("INV").alias("sv_type"))

    _, found = nested.until_stable(call, dna_chunks(spark, sf_dir), 6, lambda store, places: sequences.inverted(store, places, SMALL))
    out = None
    for k, table in enumerate(found):
        own = table.select(F.col("chrom").cast("long").alias("doc_id"), F.lit(k + 1).alias("round"), "start", "stop")
        out = own if out is None else out.unionByName(own)
    return out


ENZYMES = [("AluI", "AGCT"), ("HaeIII", "GGCC"), ("MboI", "GATC"), ("TaqI", "TCGA"), ("EcoRI", "GAATTC"), ("RsaI", "GTAC")]


@query(cte("snp") + """, fa AS (SELECT concat('c', g) AS chrom, string_agg(substr('ACGTTGCAGGATCCAGCTTCGAAGTACGGCC', CAST((i * (g + 3) * (g + 7) + i // 3) % 29 + 1 AS INT), 2), '' ORDER BY i) AS seq FROM range(0, 2600) r(i), range(0, 4) q(g) GROUP BY g),
e(enzyme, site) AS (VALUES """ + ", ".join(f"('{n}', '{s}')" for n, s in ENZYMES) + """),
x AS (SELECT snp.*, fa.seq, substr(seq, pos - 5, 11) AS w FROM snp JOIN fa USING (chrom)),
y AS (SELECT chrom, pos, seq, 'con' AS allele, con AS base, con_freq AS freq, substr(w, 1, 5) || con || substr(w, 7) AS own, substr(w, 1, 5) || mut || substr(w, 7) AS other FROM x UNION ALL SELECT chrom, pos, seq, 'mut', mut, mut_freq, substr(w, 1, 5) || mut || substr(w, 7), substr(w, 1, 5) || con || substr(w, 7) FROM x),
h AS (SELECT * FROM y JOIN e ON contains(own, site) AND NOT contains(other, site)), t AS (SELECT *, unnest([450, 400, 350, 300, 250, 200, 150, 100, 50]) AS before FROM h), u AS (SELECT *, substr(substr(seq, pos - before + 1, 500), 1, before - 1) || base || substr(substr(seq, pos - before + 1, 500), before + 1) AS tile FROM t WHERE pos - before >= 0),
c AS (SELECT *, CAST((length(tile) - length(replace(tile, site, ''))) / length(site) AS INT) AS sites FROM u)
SELECT chrom, pos, allele, freq, enzyme, CAST(before AS INT) AS before, sites, CASE WHEN sites = 2 THEN array_to_string(list_transform(string_split(tile, site), lambda x: length(x)), '.') END AS lengths, md5(tile) AS tile FROM c WHERE sites <= 2""")
def caps_sites(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = "ACGTTGCAGGATCCAGCTTCGAAGTACGGCC"
    seqs = [(f"c{g}", "".join(text[k : k + 2] for i in range(2600) for k in [(i * (g + 3) * (g + 7) + i // 3) % 29])) for g in range(4)]
    fasta = spark.createDataFrame(seqs, "chrom string, seq string")
    enzymes = spark.createDataFrame(ENZYMES, "name string, site string")
    found = markers.caps_sites(spark_table(spark, sf_dir, "snp"), fasta, enzymes)
    return found.withColumn("tile", F.md5("tile"))


PILE = cte("pile") + r""", b AS (SELECT chrom, pos, upper(regexp_replace(replace(cols, ';', ','), '\^.|\$', '', 'g')) AS b, len(string_split(cols, ';')) // 3 AS samples FROM pile),
n AS (SELECT chrom, pos, samples, unnest(['A', 'T', 'C', 'G']) AS base, unnest([1, 2, 3, 4]) AS k, b FROM b), c AS (SELECT chrom, pos, samples, base, k, length(b) - length(replace(b, base, '')) AS n FROM n),
r AS (SELECT *, row_number() OVER (PARTITION BY chrom, pos ORDER BY n DESC, k) AS p, CAST(sum(n) OVER (PARTITION BY chrom, pos) AS BIGINT) AS total FROM c),
s AS (SELECT chrom, pos, samples, max(CASE WHEN p = 1 THEN base END) AS con, max(CASE WHEN p = 2 THEN base END) AS mut, max(CASE WHEN p = 1 THEN n END) AS con_n, max(CASE WHEN p = 2 THEN n END) AS mut_n, max(total) AS total FROM r GROUP BY chrom, pos, samples)
SELECT chrom, pos, con, mut, con_n, mut_n, half_even(con_n / {by}, 3) AS con_freq, half_even(mut_n / {by}, 3) AS mut_freq FROM s WHERE {by} > 0 AND half_even(con_n / {by}, 3) < 0.95 AND mut_n > 0"""


def _pileup(spark: SparkSession, sf_dir: str, by_samples: bool) -> DataFrame:
    return markers.pileup_snps(spark_table(spark, sf_dir, "pile").withColumn("columns", F.split("cols", ";")), by_samples=by_samples)


@query(PILE.replace("{by}", "samples"))
def pileup_freq(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _pileup(spark, sf_dir, True)


@query(PILE.replace("{by}", "total"))
def pileup_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _pileup(spark, sf_dir, False)


@query(cte("info") + r""" SELECT event_id, regexp_extract(info, 'SVTYPE=([^;]*)', 1) AS sv_type, CASE WHEN info LIKE '%SV_START=%' THEN CAST(regexp_extract(info, 'SV_START=([0-9]+)', 1) AS BIGINT) ELSE pos END AS start,
CAST(regexp_extract(info, 'END=(?:[^;:]*:)?([0-9]+)', 1) AS BIGINT) AS stop, CAST(regexp_extract(info, 'SVLEN=([0-9]+)', 1) AS BIGINT) AS sv_len, regexp_replace(info, 'SVLEN=[0-9]+', 'SVLEN=7') AS changed FROM info""")
def vcf_info_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = scalars.info_map(F.col("info"))
    get = lambda k: F.try_element_at(m, F.lit(k))
    return spark_table(spark, sf_dir, "info").select(
        "event_id", get("SVTYPE").alias("sv_type"), F.coalesce(get("SV_START").cast("long"), "pos").alias("start"), scalars.end_position(get("END")).alias("stop"), get("SVLEN").cast("long").alias("sv_len"), scalars.info_set(F.col("info"), "SVLEN", F.lit(7)).alias("changed"),
    )


@query(cte("sig", "cov") + """, p AS (SELECT svid, stop, chrom, CAST(floor(start + i * (stop - start) / 7) AS BIGINT) AS pt FROM (SELECT *, unnest([1, 2, 3, 4, 5, 6]) AS i FROM sig WHERE sv_type = 'DEL')),
d AS (SELECT DISTINCT svid, stop, chrom, pt FROM p), c AS (SELECT d.svid, d.stop, d.pt, count(cov.read_id) AS n FROM d LEFT JOIN cov ON d.chrom = cov.chrom AND d.pt BETWEEN cov.start AND cov.stop GROUP BY ALL)
SELECT svid, stop, CAST(sum(CASE WHEN n = 0 THEN 1 ELSE 0 END) AS BIGINT) AS empty_points FROM c GROUP BY svid, stop""")
def zero_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = sig(spark, sf_dir).where("sv_type = 'DEL'").select("svid", "chrom", "start", "stop").distinct()
    return genotypes.uncovered_points(rows, spark_table(spark, sf_dir, "cov"), ["svid", "stop"]).select("svid", "stop", "empty_points")


TOLERANCE_SQL = {
    "high": "CASE WHEN sv_len <= 100 THEN 50 + ceil(0.8 * (sv_len - 50)) WHEN sv_len <= 500 THEN 100 + ceil(0.8 * (sv_len - 100)) WHEN sv_len <= 5000 THEN 450 + ceil(0.1 * (sv_len - 500)) ELSE 1000 END",
    "high_ins": "CASE WHEN sv_len <= 100 THEN 40 + 0.8 * (sv_len - 50) WHEN sv_len <= 500 THEN 80 + 0.8 * (sv_len - 100) WHEN sv_len <= 5000 THEN 400 + 0.1 * (sv_len - 500) ELSE 1000 END",
    "low": "CASE WHEN sv_len <= 100 THEN 25 + ceil(0.8 * (sv_len - 50)) WHEN sv_len <= 500 THEN 50 + ceil(0.8 * (sv_len - 100)) WHEN sv_len <= 5000 THEN 100 + ceil(0.1 * (sv_len - 500)) ELSE 800 END",
    "low_ins": "CASE WHEN sv_len <= 100 THEN 25 + 0.4 * (sv_len - 50) WHEN sv_len <= 500 THEN 50 + 0.4 * (sv_len - 100) WHEN sv_len <= 5000 THEN 200 + 0.05 * (sv_len - 500) ELSE 800 END",
}


@query(cte("sig") + " SELECT DISTINCT sv_len, " + ", ".join(f"CAST({v} AS DOUBLE) AS {n}" for n, v in TOLERANCE_SQL.items()) + " FROM sig")
def sv_tolerance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sig(spark, sf_dir).select("sv_len", *[scalars.tolerance(F.col("sv_len"), n).alias(n) for n in TOLERANCE_SQL]).distinct()


@query(cte("sig") + r""", t AS (SELECT k1, k2, k3, k4, concat(chrom, ':', start, '-', stop, '_', sv_type, CASE WHEN k1 % 2 = 0 THEN 'LEN' ELSE '' END, '=', sv_len) AS x, chrom FROM sig)
SELECT k1, k2, k3, k4, regexp_extract(x, '^(.*):', 1) AS chrom, CAST(regexp_extract(x, ':([0-9]+)-', 1) AS BIGINT) AS start, CAST(regexp_extract(x, '-([0-9]+)_', 1) AS BIGINT) AS stop, regexp_extract(x, '_([A-Z]{3})', 1) AS sv_type, CAST(regexp_extract(x, '=([0-9]+)$', 1) AS BIGINT) AS size,
CAST(regexp_extract(chrom, '[0-9]+') AS INT) AS ord FROM t""")
def svid_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = sig(spark, sf_dir)
    named = rows.withColumn("x", F.concat("chrom", F.lit(":"), "start", F.lit("-"), "stop", F.lit("_"), "sv_type", F.when(F.col("k1") % 2 == 0, "LEN").otherwise(""), F.lit("="), "sv_len"))
    parts = scalars.svid_parts(F.col("x"))
    return named.select(*K, *[parts[n].alias(n) for n in ("chrom", "start", "stop", "sv_type", "size")], scalars.chrom_order(F.col("chrom")).alias("ord"))


@query(cte("sig", "cov") + """, p AS (SELECT k1, k2, k3, k4, cluster_size AS reads, chrom, start - 250 AS l0, start - 100 AS l1, stop + 100 AS r0, stop + 250 AS r1 FROM sig),
a AS (SELECT p.k1, p.k2, p.k3, p.k4, reads, count(cov.read_id) AS left_n FROM p LEFT JOIN cov ON p.chrom = cov.chrom AND cov.start <= l0 AND cov.stop >= l1 GROUP BY ALL),
b AS (SELECT p.k1, p.k2, p.k3, p.k4, count(cov.read_id) AS right_n FROM p LEFT JOIN cov ON p.chrom = cov.chrom AND cov.start <= r0 AND cov.stop >= r1 GROUP BY ALL),
r AS (SELECT *, CASE WHEN greatest(left_n, right_n) = 0 THEN 1.0 ELSE half_even(reads / greatest(left_n, right_n), 2) END AS rate FROM a JOIN b USING (k1, k2, k3, k4))
SELECT k1, k2, k3, k4, left_n, right_n, rate AS sv_rate FROM r WHERE rate >= 0.5""")
def sv_assembly_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    cov = spark_table(spark, sf_dir, "cov")
    rows = sig(spark, sf_dir).select(*K, "chrom", F.col("cluster_size").alias("reads"), (F.col("start") - 250).alias("l0"), (F.col("start") - 100).alias("l1"), (F.col("stop") + 100).alias("r0"), (F.col("stop") + 250).alias("r1"))
    both = intervals.count_covering(intervals.count_covering(rows, cov, K, "left_n", ("chrom", "l0", "l1")), cov, K, "right_n", ("chrom", "r0", "r1"))
    return clusters.accept_assembly(both, 0.5).select(*K, "left_n", "right_n", "sv_rate")


def _primer_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark_table(spark, sf_dir, "dna").select(F.col("doc_id").cast("string").alias("id"), "seq", F.lit(60).cast("long").alias("sv_size"))


@query(None)
def primer_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best pair of primers of each sequence, of all pairs; tests compare it with plain Python."""
    rows = markers.pairable(_primer_templates(spark, sf_dir), flank=120)
    return markers.best_primers(markers.primer_candidates(rows, flank=120), rows).select("id", "f_pos", "f_primer", "r_pos", "r_primer", "ref_size", "alt_size", "score")


@query(None)
def primer_ranked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best-ranked primer of either side of each sequence."""
    rows = _primer_templates(spark, sf_dir)
    return markers.best_ranked_primers(markers.primer_candidates(rows, tm=(53.0, 65.0), gc=(40.0, 80.0), flank=120), rows)
