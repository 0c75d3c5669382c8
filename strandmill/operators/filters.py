"""Row filters of reads, signals, candidates and markers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def signal_reads(reads: DataFrame, min_mapq: int = 30, assembly: bool = False) -> DataFrame:
    """Reads that can give signals: primary or supplementary on either strand; of assemblies all but unmapped ones."""
    kind = F.col("flag") != 4 if assembly else F.col("flag").isin(0, 16, 2048, 2064)
    return reads.where(kind & (F.col("mapq") >= min_mapq))


def genotype_reads(reads: DataFrame, min_mapq: int | None = None) -> DataFrame:
    """Mapped reads; long reads have no quality bound (None)."""
    mapped = F.col("flag").bitwiseAND(4) == 0
    return reads.where(mapped if min_mapq is None else mapped & (F.col("mapq") >= min_mapq))


def long_operations(reads: DataFrame, most: int = 265_000_000, only_clips: bool = False) -> DataFrame:
    """Drops reads one of whose CIGAR operations (clips only, if asked) is longer than most."""
    sizes = F.regexp_extract_all("cigar", F.lit("([0-9]+)[HS]" if only_clips else "([0-9]+)[MIDNSHP=X]"), F.lit(1))
    return reads.where(F.forall(sizes, lambda n: n.cast("long") <= most))


def signal_sizes(signals: DataFrame, least: int = 40, most: int = 10_000_000, min_mapq: int | None = None) -> DataFrame:
    kept = signals.where((F.col("sv_len") >= least) & (F.col("sv_len") <= most))
    return kept if min_mapq is None else kept.where(F.col("maq") >= min_mapq)


def supported(candidates: DataFrame, reads: int | None = None, rate: float | None = None, both: bool = False) -> DataFrame:
    """By reads, by rate, by either if both numbers are given, by each of them if both is set."""
    by_reads = F.col("cluster_size") >= reads if reads is not None else None
    by_rate = F.col("sv_rate") >= rate if rate is not None else None
    if by_reads is None or by_rate is None:
        keep = by_reads if by_rate is None else by_rate
        return candidates if keep is None else candidates.where(keep)
    return candidates.where(by_reads & by_rate if both else by_reads | by_rate)


def inversion_guard(signals: DataFrame, sizes: DataFrame, part: int = 4) -> DataFrame:
    """Drops inversions not under a quarter of their chromosome; those of a chromosome without a size stay. sizes: chrom, size, one row a chromosome."""
    joined = signals.join(sizes.select("chrom", "size"), "chrom", "left")
    return joined.where((F.col("sv_type") != "INV") | F.coalesce(F.col("sv_len") < F.col("size") / part, F.lit(True))).drop("size")


def segment_reads(segments: DataFrame, assembly: bool = False) -> DataFrame:
    """Reads with enough segments: 2 to 20 with a primary among them, or of assemblies 2 at least.
    Counts come from one aggregate by read; rows of the same read stay together for what follows."""
    by = Window.partitionBy("qname")
    counted = segments.withColumns({"n": F.count(F.lit(1)).over(by), "primary_n": F.count(F.when(F.col("flag") <= 16, 1)).over(by)})
    fits = F.col("n") >= 2 if assembly else F.col("n").between(2, 20) & (F.col("primary_n") > 0)
    return counted.where(fits).drop("n", "primary_n")


def marker_sites(sites: DataFrame, maf: tuple[float, float] = (0.05, 0.95), size: tuple[int, int] = (50, 500)) -> DataFrame:
    return sites.where(F.col("maf").between(*maf) & F.abs("size").between(*size))


def snp_sites(snps: DataFrame, chroms: DataFrame, margin: int = 500) -> DataFrame:
    """SNPs of plain bases, at least margin from both ends of their sequence; chroms: chrom, size."""
    plain = F.col("con").isin("A", "C", "G", "T") & F.col("mut").isin("A", "C", "G", "T")
    joined = snps.join(chroms.select("chrom", "size"), "chrom")
    return joined.where(plain & (F.col("pos") > margin) & (F.col("pos") < F.col("size") - margin)).drop("size")


def indels(vcf: DataFrame) -> DataFrame:
    return vcf.where(F.col("alt").isin("<DEL>", "<INS>"))


def sane_cds(features: DataFrame) -> DataFrame:
    return features.where((F.col("feature") != "CDS") | (F.col("start") < F.col("stop")))

