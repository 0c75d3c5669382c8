"""Positional windows: anchored windows (adaptive, fixed, translocation, merge runs) and gap windows.

An anchored window begins at its first row and takes the rows that start before anchor + width, the
width following from the anchor row (anchors.py). Windows are numbered within islands, which gaps that no anchor
can bridge part.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from strandmill.operators.anchors import anchored
from strandmill.operators.runs import by_island, islands

WIDEST = 1500.0


def adaptive_width(size: np.ndarray) -> np.ndarray:
    """Width by the anchor's length; a length of exactly 100 falls to the widest."""
    return np.select([size < 100, (size > 100) & (size <= 500), (size > 500) & (size <= 1000)], [200 + 0.5 * size, 400 + 0.5 * size, 600 + 0.5 * size], WIDEST)


def adaptive_windows(signals: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    return anchored(signals, keys, order, adaptive_width, WIDEST)


def fixed_windows(signals: DataFrame, keys: list[str], order: list[str], window: int = 500, deletion_extra: int = 250) -> DataFrame:
    """Width window, for deletions deletion_extra more; keys must hold sv_type."""
    widest = float(window + deletion_extra)
    wide = signals.withColumn("__width", F.lit(window) + F.when(F.col("sv_type") == "DEL", deletion_extra).otherwise(0))
    return anchored(wide, keys, order, lambda w: w.astype(float), widest, size="__width").drop("__width")


def translocation_windows(signals: DataFrame, keys: list[str], order: list[str], width: int = 2_000_000) -> DataFrame:
    """Per pair of chromosomes, on the first one's position; 2,000,000 for long reads, 1,000,000 else."""
    return anchored(signals, keys, order, lambda s: np.full(len(s), float(width)), float(width), size="start")


def kept_windows(windows: DataFrame, keys: list[str], depth: float, nreads: int = 5, most: int = 10, least: int | None = None, longest: int | None = 5000) -> DataFrame:
    """Rows of windows with enough distinct reads and fewer than depth * most, or of insertions whose longest is 5000 at least.
    least: 3 of nreads 5 or more, else 2; longest=None: no such insertions."""
    least = least if least is not None else 3 if nreads >= 5 else 2
    ident = [*keys, "island", "window"]
    stats = windows.groupBy(*ident).agg(F.count_distinct("query_name").alias("reads"), F.max("sv_len").alias("longest"))
    fits = (F.col("reads") >= least) & (F.col("reads") < depth * most)
    if longest is not None:
        fits = fits | ((F.col("sv_type") == "INS") & (F.col("longest") >= longest))
    return windows.join(stats, ident).where(fits).drop("longest")


def kept_fixed_windows(windows: DataFrame, keys: list[str], depth: float) -> DataFrame:
    """Windows of one width: those of two reads at least and fewer than a hundred times the depth."""
    return kept_windows(windows, keys, depth, most=100, least=2, longest=None)


def kept_break_windows(windows: DataFrame, keys: list[str], depth: float, nreads: int = 5) -> DataFrame:
    """Where clip ends will confirm candidates, one read keeps a window, of nreads 6 or more three do."""
    return kept_windows(windows, keys, depth, least=3 if nreads >= 6 else 1)


def gap_windows(signals: DataFrame, keys: list[str], order: list[str], window: int = 500, deletion_extra: int = 250) -> DataFrame:
    """A row joins its predecessor while it starts before the predecessor's start + window; adds island."""
    reach = F.lit(window) + F.when(F.col("sv_type") == "DEL", deletion_extra).otherwise(0)
    return islands(signals, keys, ["start", *order], lambda prev: F.col("start") >= prev("start") + reach)


def merge_close(table: DataFrame, reach: int = 800, by_chrom: bool = True) -> DataFrame:
    """Runs of one chromosome and type that begin within reach of the run's first row become that row,
    target_size summed. by_chrom=False keeps the looser order, by type and start over all chromosomes,
    in which a row of another chromosome ends a run."""
    if by_chrom:
        runs = anchored(table, ["chrom", "sv_type"], ["stop", "target_size"], lambda s: np.full(len(s), float(reach)), float(reach), size="target_size")
        ident = ["chrom", "sv_type", "island", "window"]
    else:
        cut = islands(table, ["sv_type"], ["start", "chrom", "stop", "target_size"], lambda prev: (F.col("chrom") != prev("chrom")) | (F.col("start") - prev("start") >= reach))
        runs = anchored(cut.withColumnRenamed("island", "stretch"), ["sv_type", "stretch"], ["chrom", "stop", "target_size"], lambda s: np.full(len(s), float(reach)), float(reach), size="target_size")
        ident = ["sv_type", "stretch", "island", "window"]
    rest = [c for c in table.columns if c not in ident and c != "target_size"]
    first = F.min(F.struct("start", "stop", "target_size", *[c for c in rest if c not in ("start", "stop")]))
    merged = runs.groupBy(*ident).agg(first.alias("f"), F.sum("target_size").alias("target_size"), F.count(F.lit(1)).alias("merged"))
    return merged.select(*[F.col(c) if c in ident or c == "target_size" else F.col(f"f.{c}").alias(c) for c in table.columns], "merged")


def adjacent(df: DataFrame, keys: list[str], order: list[str], shift: int, ratio: tuple[float, float] = (0.8, 1.2), work: Callable[[DataFrame, list[str]], DataFrame] | None = None) -> DataFrame:
    """Clusters of rows near their predecessor in start, stop and length; adds island, or is work() of whole islands (by_island)."""
    def apart(prev: Callable[[str], Column]) -> Column:
        share = F.try_divide(prev("sv_len"), F.col("sv_len"))
        return ~((F.abs(F.col("start") - prev("start")) <= shift) & (F.abs(F.col("stop") - prev("stop")) <= shift) & (share > ratio[0]) & (share < ratio[1]))

    return islands(df, keys, ["start", *order], apart) if work is None else by_island(df, keys, ["start", *order], apart, work)


def adjacent_pairs(df: DataFrame, order: list[str], shift: int, work: Callable[[DataFrame, list[str]], DataFrame] | None = None) -> DataFrame:
    """Translocations, per pair of chromosomes: rows near their predecessor on both sides; adds island, or is work() of whole islands."""
    near = lambda prev: (F.abs(F.col("start") - prev("start")) <= 2 * shift) & (F.abs(F.col("start2") - prev("start2")) <= 2 * shift)
    keys, places = ["chrom", "chrom2"], ["start", "start2", *order]
    return islands(df, keys, places, lambda prev: ~near(prev)) if work is None else by_island(df, keys, places, lambda prev: ~near(prev), work)


def nested_apart(gap: int = 5000) -> Callable[[Callable[[str], Column]], Column]:
    """A row joins while it starts at most gap after the stop of the row before (not of all before)."""
    return lambda prev: F.col("start") > prev("stop") + gap


def nested_gaps(df: DataFrame, keys: list[str], order: list[str], gap: int = 5000) -> DataFrame:
    return islands(df, keys, ["start", *order], nested_apart(gap))


def neighbours(df: DataFrame, keys: list[str], order: list[str], value: Column, k: int = 5) -> Column:
    """Values of the rows k before to k after in order, clipped at the ends."""
    return F.collect_list(value).over(Window.partitionBy(*keys).orderBy(*order).rowsBetween(-k, k))
