"""Readers: alignments (SAM, BAM), FASTA, VCF, GFF, tables of signals and candidates, pileups, enzymes, user variants.

Text formats are read by Spark's own text and CSV readers, so paths may be in any store it reads;
compressed files follow their extension. Missing paths give empty tables where missing="empty".
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from strandmill import schema
from strandmill.functions.scalars import end_position, info_map
from strandmill.operators.runs import placed
from strandmill.operators.sequences import CHUNK
from strandmill.sources.bam import bam  # noqa: F401


def _or_empty(spark: SparkSession, read, columns: str, missing: str) -> DataFrame:
    try:
        return read()
    except AnalysisException as problem:
        if missing == "empty" and "PATH_NOT_FOUND" in str(problem):
            return spark.createDataFrame([], columns)
        raise


def tsv(spark: SparkSession, path: str, columns: str, header: bool = False, missing: str = "fail") -> DataFrame:
    """A tab-separated table with explicit columns and the file's path as `file`."""
    read = lambda: spark.read.csv(path, sep="\t", schema=columns, header=header, quote="").withColumn("file", F.col("_metadata.file_path"))
    return _or_empty(spark, read, columns + ", file string", missing)


def with_sample(table: DataFrame, suffix: str) -> DataFrame:
    """sample: the file's name without folder and suffix."""
    return table.withColumn("sample", F.regexp_extract("file", rf"([^/]+?){suffix}$", 1))


def sam(spark: SparkSession, path: str, longest_operation: int = 1_000_000) -> DataFrame:
    """Alignment lines; positions count from 0 here. Lines with an operation above longest_operation go."""
    lines = spark.read.text(path).where(~F.col("value").startswith("@"))
    f = F.split("value", "\t")
    tag = F.filter(F.slice(f, 12, F.greatest(F.size(f), F.lit(1))), lambda t: t.startswith("SA:Z:"))
    out = lines.where(F.size(f) >= 11).select(
        F.get(f, F.lit(0)).alias("qname"), F.get(f, F.lit(1)).cast("int").alias("flag"), F.get(f, F.lit(2)).alias("rname"), (F.get(f, F.lit(3)).cast("long") - 1).alias("pos"),
        F.get(f, F.lit(4)).cast("int").alias("mapq"), F.get(f, F.lit(5)).alias("cigar"), F.get(f, F.lit(9)).alias("seq"), F.substring(F.get(tag, F.lit(0)), 6, 1 << 30).alias("sa"),
    )
    sizes = F.regexp_extract_all("cigar", F.lit("([0-9]+)[MIDNSHP=X]"), F.lit(1))
    return out.where(F.forall(sizes, lambda n: n.cast("long") <= longest_operation))


def fasta(spark: SparkSession, path: str) -> DataFrame:
    """chrom (the header's first word) and seq. Lines get their place in the file, each belongs to the last header before it."""
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("at"))
    order = Window.partitionBy("file").orderBy("block", "at")
    marked = lines.withColumn("record", F.sum(F.col("value").startswith(">").cast("int")).over(order.rowsBetween(Window.unboundedPreceding, 0)))
    grouped = marked.where("record > 0").groupBy("file", "record").agg(F.array_sort(F.collect_list(F.struct("block", "at", "value"))).alias("l"))
    head = F.get("l", F.lit(0))["value"]
    return grouped.select(F.regexp_extract(head, r"^>\s*(\S+)", 1).alias("chrom"), F.array_join(F.transform(F.slice("l", 2, F.greatest(F.size("l"), F.lit(1))), lambda x: F.trim(x["value"])), "").alias("seq"))


def fasta_chunks(spark: SparkSession, path: str, size: int = CHUNK) -> DataFrame:
    """The sequences of FASTA files as chunks (chrom, chunk, text) of size letters. Files are read by blocks: a line's place
    in its sequence follows from the lengths before it in its block, and one row of each block and record carries lengths
    and records over the blocks' edges. A compressed file is one block. Of records of one name the last counts."""
    lines = spark.read.text(path).select(F.trim("value").alias("value"), F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("at"))
    head = F.col("value").startswith(">")
    up_to = Window.partitionBy("file", "block").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    marked = lines.withColumns({"local": F.sum(head.cast("int")).over(up_to), "n": F.when(head, 0).otherwise(F.length("value")).cast("long")})
    placed = marked.withColumn("inner", F.sum("n").over(Window.partitionBy("file", "block", "local").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)) - F.col("n"))
    parts = marked.groupBy("file", "block", "local").agg(F.sum("n").alias("n"), F.max(F.when(head, F.regexp_extract("value", r"^>\s*(\S+)", 1))).alias("name"))
    blocks = parts.groupBy("file", "block").agg(F.max("local").alias("records"))
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.withColumn("earlier", F.coalesce(F.sum("records").over(earlier), F.lit(0))).drop("records")
    along = Window.partitionBy("file", "record")
    parts = parts.join(blocks, ["file", "block"]).withColumn("record", F.col("earlier") + F.col("local")).where("record > 0")
    parts = parts.withColumns({"chrom": F.max("name").over(along), "before": F.coalesce(F.sum("n").over(along.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))})
    last = Window.partitionBy("chrom")
    parts = parts.withColumn("newest", F.max(F.struct("file", "record")).over(last)).where("file = newest.file and record = newest.record")
    body = placed.where("n > 0").join(parts.select("file", "block", "local", "chrom", "before"), ["file", "block", "local"]).withColumn("start", F.col("before") + F.col("inner"))
    pieces = body.withColumn("chunk", F.explode(F.sequence(F.floor(F.col("start") / size), F.floor((F.col("start") + F.col("n") - 1) / size))))
    low, high = F.greatest("start", F.col("chunk") * size), F.least(F.col("start") + F.col("n"), (F.col("chunk") + 1) * size)
    cut = pieces.select("chrom", "chunk", F.struct(low.alias("place"), F.substring(F.col("value"), (low - F.col("start") + 1).cast("int"), (high - low).cast("int")).alias("text")).alias("p"))
    return cut.groupBy("chrom", "chunk").agg(F.array_sort(F.collect_list("p")).alias("p")).select("chrom", "chunk", F.array_join(F.transform("p", lambda x: x["text"]), "").alias("text"))


def fai(spark: SparkSession, path: str) -> DataFrame:
    """chrom, size and rank, the chromosome's place in the index."""
    table = spark.read.csv(path, sep="\t", schema="chrom string, size long, offset long, line int, bytes int")
    return placed(table, ["offset"], "rank").select("chrom", "size", F.col("rank").cast("int").alias("rank"))


def vcf(spark: SparkSession, path: str) -> DataFrame:
    """One row per variant and sample: the fixed columns, sample, call (its text) and gt."""
    lines = spark.read.text(path).withColumn("file", F.col("_metadata.file_path"))
    heads = lines.where(F.col("value").startswith("#CHROM")).select("file", F.split("value", "\t").alias("h"))
    body = lines.where(~F.col("value").startswith("#") & (F.col("value") != "")).select("file", F.split("value", "\t").alias("f")).join(heads, "file")
    names = ["chrom", "pos", "id", "ref", "alt", "qual", "filter", "info", "format"]
    fixed = [F.get("f", F.lit(k)).alias(n) for k, n in enumerate(names)]
    calls = F.arrays_zip(F.slice("h", 10, F.greatest(F.size("h"), F.lit(1))).alias("sample"), F.slice("f", 10, F.greatest(F.size("f"), F.lit(1))).alias("call"))
    long = body.select(*fixed, F.explode_outer(calls).alias("c")).withColumn("pos", F.col("pos").cast("long"))
    at = F.array_position(F.split("format", ":"), "GT")
    return long.select(*names, F.col("c.sample").alias("sample"), F.col("c.call").alias("call"), F.when(at > 0, F.get(F.split("c.call", ":"), (at - 1).cast("int"))).alias("gt"))


def sv_intervals(table: DataFrame) -> DataFrame:
    """Intervals of VCF rows: start from SV_START or POS, stop from END (of chr:pos the position) or start."""
    m = info_map(F.col("info"))
    get = lambda k: F.try_element_at(m, F.lit(k))
    start = F.coalesce(get("SV_START").cast("long"), F.col("pos"))
    stop = F.coalesce(end_position(get("END")), F.col("pos"))
    return table.withColumns({"start": start, "stop": stop, "sv_type": get("SVTYPE"), "sv_len": F.coalesce(get("SVLEN").cast("long"), stop - start + 1)}).where("sv_type is not null")


def gff(spark: SparkSession, path: str, gtf: bool = False) -> tuple[DataFrame, DataFrame]:
    """Genes and coding parts. Genes are mRNA or transcript rows."""
    table = spark.read.csv(path, sep="\t", schema=schema.GFF, comment="#", quote="")
    attr = lambda k: F.nullif(F.regexp_extract("attrs", rf'{k} "([^"]+)"' if gtf else rf"(?:^|;)\s*{k}=([^;]+)", 1), F.lit(""))
    gene_id = attr("transcript_id") if gtf else attr("ID")
    genes = table.where(F.col("feature").isin("mRNA", "transcript")).select(gene_id.alias("gene"), "chrom", "start", "stop", "strand")
    cds = table.where((F.col("feature") == "CDS") & (F.col("start") < F.col("stop"))).select((attr("transcript_id") if gtf else F.coalesce(attr("Parent"), attr("ID"))).alias("gene"), "start", "stop")
    return genes, cds


def pileup(spark: SparkSession, path: str) -> DataFrame:
    """chrom, pos, ref and columns: the texts of all samples, three each (depth, bases, qualities)."""
    f = F.split("value", "\t")
    return spark.read.text(path).where(F.size(f) >= 5).select(F.get(f, F.lit(0)).alias("chrom"), F.get(f, F.lit(1)).cast("long").alias("pos"), F.get(f, F.lit(2)).alias("ref"), F.slice(f, 4, F.greatest(F.size(f), F.lit(1))).alias("columns"))


def enzymes(spark: SparkSession, path: str) -> DataFrame:
    """name, site and cut; further fields of a line are left out."""
    f = F.split(F.trim("value"), r"\s+")
    return spark.read.text(path).where(F.size(f) >= 3).select(F.get(f, F.lit(0)).alias("name"), F.get(f, F.lit(1)).alias("site"), F.get(f, F.lit(2)).alias("cut"))


def user_variants(spark: SparkSession, path: str) -> DataFrame:
    """Candidates from lines "chrom start length TYPE" or "chromA posA chromB posB"; shorter lines are skipped.
    The second chromosome is a column of its own (chrom2, start2)."""
    f = F.split(F.trim("value"), r"\s+")
    g = lambda k: F.get(f, F.lit(k))
    lines = spark.read.text(path).where(F.size(f) >= 4)
    known = F.upper(g(3)).isin("DEL", "INS", "DUP", "INV")
    start, size, kind = g(1).cast("long"), F.when(known, g(2).cast("long")).otherwise(0), F.when(known, F.upper(g(3))).otherwise("TRA")
    stop = F.when(kind == "INS", start + 1).when(kind == "TRA", start).otherwise(start + size)
    svid = F.when(kind == "TRA", F.concat(g(2), F.lit(":"), g(3), F.lit("_"), g(0), F.lit(":"), g(1))).otherwise(F.concat(g(0), F.lit(":"), start.cast("string"), F.lit("-"), stop.cast("string"), F.lit("_"), kind, F.lit("="), size.cast("string")))
    return lines.select(
        g(0).alias("chrom"), start.alias("start"), stop.alias("stop"), size.alias("sv_len"), svid.alias("svid"), kind.alias("sv_type"), F.lit("*").alias("seq"), F.lit(60).alias("maq"), F.lit(1).cast("long").alias("cluster_size"), F.lit(1.0).alias("sv_rate"),
        F.when(kind == "TRA", g(2)).alias("chrom2"), F.when(kind == "TRA", g(3).try_cast("long")).alias("start2"),
    )


def paired_reads(spark: SparkSession, folder: str, suffix: str = ".fastq.gz") -> DataFrame:
    """sample, first and second file of paired reads, by names that end in _1 or _R1 and _2 or _R2 before the suffix."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder).select("path")
    name = F.regexp_extract("path", rf"([^/]+?)[._]R?([12]){suffix.replace('.', chr(92) + '.')}$", 1)
    side = F.regexp_extract("path", rf"([^/]+?)[._]R?([12]){suffix.replace('.', chr(92) + '.')}$", 2)
    named = files.withColumns({"sample": name, "side": side}).where("sample <> ''")
    return named.groupBy("sample").agg(F.min(F.when(F.col("side") == "1", F.col("path"))).alias("first"), F.min(F.when(F.col("side") == "2", F.col("path"))).alias("second"))
