"""Writers: partitioned tables, genotype tables, VCF, FASTA."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandmill.functions.scalars import chrom_order


#: INFO keys (name, type, description) and alleles of the VCF header; fixed values.
INFO_KEYS = [
    ("CHR", "String", "Chromosome"), ("SV_START", "Integer", "Start"), ("END", "String", "End"), ("maq", "Integer", "Mean mapping quality"), ("SVLEN", "Integer", "Length"), ("method", "String", "Caller"),
    ("total_map_reads", "Integer", "Reads at the variant"), ("INS_rate", "Float", "Share of reads with the insertion"), ("SVTYPE", "String", "Type"), ("total_map_reads_l", "Integer", "Reads at the first breakpoint"),
    ("total_map_reads_r", "Integer", "Reads at the second breakpoint"), ("l_ratio", "Float", "Share of reads at the first breakpoint"), ("r_ratio", "Float", "Share of reads at the second breakpoint"),
]
ALLELES = [("DEL", "Deletion"), ("INS", "Insertion"), ("DUP", "Duplication"), ("INV", "Inversion"), ("TRA", "Translocation")]


def by_parts(table: DataFrame, path: str, *parts: str, mode: str = "overwrite") -> None:
    """Parquet in folders by parts (sample and chrom of signals, sv_type of clusters); rows are gathered by part first, so each folder gets few files."""
    table.repartition(*parts).write.mode(mode).partitionBy(*parts).parquet(path)


def tsv(table: DataFrame, path: str, header: bool = True) -> None:
    table.write.mode("overwrite").csv(path, sep="\t", header=header, quote="", emptyValue="")


def genotype_table(calls: DataFrame, path: str) -> None:
    """Distinct genotype rows in order of place."""
    tsv(calls.dropDuplicates().orderBy(chrom_order(F.col("chrom")), "chrom", "start", "stop"), path)


def vcf_rows(calls: DataFrame, sample: str) -> DataFrame:
    """VCF columns of genotype rows: chrom, start, stop, sv_type, target_size, gt, and if there are such columns maps and rates
    (the support's texts, as genotypes.support_text makes them), maq, and of translocations chrom2 (END is then chrom2:stop)."""
    size = F.abs("target_size")
    end = F.col("stop").cast("string")
    if "chrom2" in calls.columns:
        end = F.when((F.col("sv_type") == "TRA") & F.col("chrom2").isNotNull(), F.concat("chrom2", F.lit(":"), end)).otherwise(end)
    told = [F.col("maps")] if "maps" in calls.columns else []
    told += [F.concat(F.lit("maq="), F.col("maq").cast("string"))] if "maq" in calls.columns else []
    told += [F.substring_index("rates", ";", 1)] if "rates" in calls.columns else []
    info = F.concat_ws(
        ";", F.concat(F.lit("END="), end), F.concat(F.lit("CHR="), "chrom"), F.concat(F.lit("SV_START="), F.col("start").cast("string")), F.concat(F.lit("SVLEN="), size.cast("string")), F.lit("method=strandmill"),
        *told, F.concat(F.lit("SVTYPE="), F.col("sv_type")),
    )
    ident = F.concat("chrom", F.lit(":"), F.col("start").cast("string"), F.lit("-"), F.col("stop").cast("string"), F.lit("_"), size.cast("string"))
    return calls.select(
        "chrom", F.col("start").cast("long").alias("pos"), ident.alias("id"), F.lit("N").alias("ref"), F.concat(F.lit("<"), "sv_type", F.lit(">")).alias("alt"),
        F.lit(".").alias("qual"), F.lit("PASS").alias("filter"), info.alias("info"), F.lit("GT").alias("format"), F.col("gt").alias(sample),
    )


def vcf_lines(rows: DataFrame, contigs: DataFrame, samples: list[str]) -> DataFrame:
    """Lines of a VCF file in order: rank, at, line. contigs: chrom, size."""
    spark: SparkSession = rows.sparkSession
    keys = [f'##INFO=<ID={k},Number=1,Type={t},Description="{d}">' for k, t, d in INFO_KEYS]
    kinds = [f'##ALT=<ID={k},Description="{d}">' for k, d in ALLELES]
    fixed = ["##fileformat=VCFv4.2", *kinds, *keys, '##FORMAT=<ID=GT,Number=1,Type=String,Description="Genotype">']
    head = spark.createDataFrame([(0, k, 0, "", x) for k, x in enumerate(fixed)], "part int, rank int, at long, id string, line string")
    named = contigs.select(F.lit(1).alias("part"), chrom_order(F.col("chrom")).alias("rank"), F.lit(0).cast("long").alias("at"), F.col("chrom").alias("id"), F.concat(F.lit("##contig=<ID="), "chrom", F.lit(",length="), F.col("size").cast("string"), F.lit(">")).alias("line"))
    columns = ["#CHROM", "POS", "ID", "REF", "ALT", "QUAL", "FILTER", "INFO", "FORMAT", *samples]
    title = spark.createDataFrame([(2, 0, 0, "", "\t".join(columns))], "part int, rank int, at long, id string, line string")
    cells = ["chrom", F.col("pos").cast("string"), "id", "ref", "alt", "qual", "filter", "info", "format", *samples]
    body = rows.select(F.lit(3).alias("part"), chrom_order(F.col("chrom")).alias("rank"), F.col("pos").alias("at"), "id", F.concat_ws("\t", *cells).alias("line"))
    return head.unionByName(named).unionByName(title).unionByName(body)


def cohort_rows(rows: DataFrame, samples: list[str], indels: bool = False) -> DataFrame:
    """VCF columns of a cohort from single samples' rows (the fixed columns, sample, gt): one row per id, info blank, missing calls
    "./."; indels keeps deletions and insertions alone."""
    kept = rows.where(F.col("alt").isin("<DEL>", "<INS>")) if indels else rows
    cell = lambda s: F.coalesce(F.max(F.when(F.col("sample") == s, F.col("gt"))), F.lit("./.")).alias(s)
    first = lambda c: F.min(c).alias(c)
    return kept.groupBy("id").agg(*map(first, ("chrom", "pos", "ref", "alt", "qual", "filter", "format")), *map(cell, samples)).select("chrom", "pos", "id", "ref", "alt", "qual", "filter", F.lit(".").alias("info"), "format", *samples)


def vcf(rows: DataFrame, contigs: DataFrame, samples: list[str], path: str, parts: int | None = None) -> None:
    """A VCF as text parts in order: range-partitioned by place, so the parts' concatenation is the file; parts=1 gives one whole file."""
    lines = vcf_lines(rows, contigs, samples)
    keys = ["part", "rank", "at", "id"]
    ranged = lines.repartitionByRange(parts, *keys) if parts else lines.repartitionByRange(*keys)
    ranged.sortWithinPartitions(*keys).select("line").write.mode("overwrite").text(path)


def demo_genotypes(table: DataFrame) -> DataFrame:
    """Made-up calls by chromosome number (to 12: 1/1, above: 0/1), for demonstrations only."""
    return table.withColumn("gt", F.when(chrom_order(F.col("chrom")) <= 12, "1/1").otherwise("0/1"))


def fasta(sequences: DataFrame, path: str, width: int = 60) -> None:
    wrapped = F.regexp_replace("seq", f"(.{{{width}}})(?=.)", "$1\n")
    sequences.select(F.concat(F.lit(">"), "chrom", F.lit("\n"), wrapped).alias("value")).write.mode("overwrite").text(path)


def fasta_chunks(store: DataFrame, path: str, width: int = 60, parts: int | None = None) -> None:
    """Chunks (chrom, chunk, text; of a multiple of width letters) as FASTA, in order of chromosome and chunk: the parts'
    concatenation is the file."""
    wrapped = F.regexp_replace("text", f"(.{{{width}}})(?=.)", "$1\n")
    lines = store.select(chrom_order(F.col("chrom")).alias("rank"), "chrom", "chunk", F.when(F.col("chunk") == 0, F.concat(F.lit(">"), "chrom", F.lit("\n"), wrapped)).otherwise(wrapped).alias("value"))
    keys = ["rank", "chrom", "chunk"]
    ranged = lines.repartitionByRange(parts, *keys) if parts else lines.repartitionByRange(*keys)
    ranged.sortWithinPartitions(*keys).select("value").write.mode("overwrite").text(path)


def primer_rows(best: DataFrame, sites: DataFrame) -> DataFrame:
    """Lines of best_primers() for people: sites (id, chrom, start, sv_type, sv_size, maf or null, seq) with products, primers, melting points and
    the rest to one place; what is missing is NA, a missing frequency N/A."""
    one = lambda c: F.coalesce(F.format_string("%.1f", F.col(c)), F.lit("NA")).alias(c)
    joined = sites.drop("sv_size").join(best, "id")
    frequency = F.coalesce(F.format_string("%.2f", "maf"), F.lit("N/A")).alias("maf")
    apart = F.format_string("%.1f", F.abs(F.col("f_tm") - F.col("r_tm"))).alias("tm_diff")
    return joined.select("chrom", F.col("start").alias("pos"), "id", "sv_type", F.abs("sv_size").alias("size"), frequency, "ref_size", "alt_size", F.col("f_primer").alias("forward"), F.col("r_primer").alias("reverse"), one("f_tm"), one("r_tm"), one("f_gc"), one("r_gc"), one("pair_tm"), apart, one("score"), "seq")
