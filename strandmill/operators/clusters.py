"""Aggregates of windows and clusters, merges of samples and cohorts, and acceptance of candidates."""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from strandmill.functions.scalars import round_half_even
from strandmill.operators.runs import by_island, map_runs, schema_with

#: Least share of reads by ploidy; fixed values.
PLOIDY_RATE = {1: 0.99, 2: 0.49, 3: 0.33, 4: 0.24, 5: 0.19, 6: 0.16, 7: 0.14, 8: 0.12}


def distinct_first(df: DataFrame, keys: list[str], order: list[Column | str]) -> DataFrame:
    """One row of each key, the first in order."""
    by = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("__k", F.row_number().over(by)).where("__k = 1").drop("__k")


def read_collapse(signals: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """One row per read of each window: repeats of (read, start, stop) go, the first by start and length
    gives start, type, quality and sequence; stops give the largest, lengths their sum."""
    once = signals.groupBy(*keys, "query_name", "start", "stop").agg(F.min(F.struct("sv_len", *order, "maq", "svid", "seq")).alias("f"))
    first = lambda c: F.min_by(F.col(f"f.{c}"), F.struct("start", "f.sv_len", *[f"f.{o}" for o in order]))
    return once.groupBy(*keys, "query_name").agg(
        first("maq").alias("maq"), first("svid").alias("svid"), first("seq").alias("seq"), F.min("start").alias("start"), F.max("stop").alias("stop"), F.sum("f.sv_len").alias("sv_len"), F.count(F.lit(1)).alias("n_signals"),
    )


def overlap_filter(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Per key, by start and longest first: a row that starts after the last kept one's stop is kept; one
    that overlaps it but stops later replaces it; others go."""

    def work(rows: pd.DataFrame) -> pd.DataFrame:
        start, stop, run = rows["start"].to_numpy(), rows["stop"].to_numpy(), rows["__run"].to_numpy()
        kept: list[int] = []
        current = -1
        for k in range(len(rows)):
            if run[k] != current or start[k] > stop[kept[-1]]:
                current = run[k]
                kept.append(k)
            elif stop[k] > stop[kept[-1]]:
                kept[-1] = k
        return rows.iloc[kept].drop(columns=["__run", "__neg"])

    signed = df.withColumn("__neg", -F.col("sv_len"))
    return map_runs(signed, keys, ["start", "__neg", *order], work, schema_with(df))


def query_collapse(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Assemblies: one row per query after overlap_filter: smallest start, largest stop, summed length."""
    kept = overlap_filter(df, [*keys, "query_name"], order)
    return kept.groupBy(*keys, "query_name").agg(F.min("start").alias("start"), F.max("stop").alias("stop"), F.sum("sv_len").alias("sv_len"), F.max("maq").alias("maq"), F.count(F.lit(1)).alias("n_signals"))


def run_collapse(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Consecutive rows of one query, in order, become one: smallest start, largest stop, summed length."""
    def work(rows: DataFrame, by: list[str]) -> DataFrame:
        return rows.groupBy(*by, "run", "query_name").agg(F.min("start").alias("start"), F.max("stop").alias("stop"), F.sum("sv_len").alias("sv_len"), F.count(F.lit(1)).alias("n_signals"))

    return by_island(df, keys, ["start", *order], lambda prev: prev("query_name") != F.col("query_name"), work, "run")


def trimmed(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Per key: the smallest mode, and the mean rounded up, of values within the quartiles (linear, inclusive), of all values
    where none lies there (as of two different ones); n values, of all.

    Counts of values are pre-aggregated; quartiles come from them, weighted."""
    v, n = F.col(value), F.col("__n")
    best = lambda when: F.max_by(F.when(when, v), F.when(when, F.struct(n, -v)))
    mean = lambda when: F.ceil(F.sum(F.when(when, v * n)) / F.sum(F.when(when, n)))
    counts = df.groupBy(*keys, value).agg(F.count(F.lit(1)).alias("__n"))
    quart = counts.groupBy(*keys).agg(F.percentile(value, F.array(F.lit(0.25), F.lit(0.75)), n).alias("__q"), F.sum(n).alias("n"))
    joined = counts.join(quart, keys)
    inside = (v >= F.col("__q")[0]) & (v <= F.col("__q")[1])
    return joined.groupBy(*keys).agg(F.first("n").alias("n"), F.coalesce(best(inside), best(F.lit(True))).alias("mode_value"), F.coalesce(mean(inside), mean(F.lit(True))).alias("mean_value"))


def top_alleles(clustered: DataFrame, keys: list[str], k: int = 2, least_share: float = 0.05) -> DataFrame:
    """The k largest clusters of each window whose largest cluster has least_share of its rows; ties to the first cluster."""
    sizes = clustered.groupBy(*keys, "cluster").agg(F.count(F.lit(1)).alias("cluster_size"), F.min("start").alias("first_start"))
    whole = Window.partitionBy(*keys)
    ranked = sizes.withColumns({"total": F.sum("cluster_size").over(whole), "top": F.max("cluster_size").over(whole), "rank": F.row_number().over(whole.orderBy(F.desc("cluster_size"), "first_start", "cluster"))})
    return ranked.where((F.col("top") / F.col("total") >= least_share) & (F.col("rank") <= k)).drop("top")


def cluster_stats(clustered: DataFrame, keys: list[str], median_stop: bool = False) -> DataFrame:
    """Per cluster: trimmed modes of start, length and quality, the largest stop (or its trimmed mode), distinct reads and
    their names in order."""
    # rows move once, to their cluster: quartiles by an unordered window, modes of those within them in place
    columns = ["start", "sv_len", "maq", *(["stop"] if median_stop else [])]
    rows = clustered.dropna(subset=keys).select(*keys, "query_name", *[F.col(c).cast("long").alias(f"__{c}") for c in columns], *([] if median_stop else ["stop"]))
    cluster = Window.partitionBy(*keys)
    rows = rows.withColumns({f"__q_{c}": F.percentile(f"__{c}", F.array(F.lit(0.25), F.lit(0.75))).over(cluster) for c in columns})
    inside = lambda c: F.when((F.col(f"__{c}") >= F.col(f"__q_{c}")[0]) & (F.col(f"__{c}") <= F.col(f"__q_{c}")[1]), F.col(f"__{c}"))
    # only of two different values does none lie within, and then the smaller one is the mode of all
    modes = [F.coalesce(F.mode(inside(c), True), F.min(f"__{c}")).alias(c) for c in columns]
    names = F.collect_set("query_name")
    found = rows.groupBy(*keys).agg(*([] if median_stop else [F.max("stop").alias("stop")]), F.size(names).cast("long").alias("reads"), F.array_sort(names).alias("reads_id"), *modes)
    return found.withColumn("maq", F.col("maq").cast("int"))


def mean_quality(reads: DataFrame, keys: list[str]) -> DataFrame:
    """Per key: mapped reads, and their mean mapping quality rounded up (0 of none)."""
    mapped = F.col("flag").bitwiseAND(4) == 0
    n = F.count(F.when(mapped, 1))
    return reads.groupBy(*keys).agg(n.alias("reads"), F.coalesce(F.ceil(F.try_divide(F.sum("mapq"), n)), F.lit(0)).cast("long").alias("maq"))


def sample_merge(islanded: DataFrame, keys: list[str], order: list[str], translocations: bool = False, more: tuple[Column, ...] = ()) -> DataFrame:
    """Per island the row of largest cluster_size (the first of equals), with the longest length (0 for
    translocations), mean quality rounded down, and sizes and rates summed; more: further aggregates."""
    ident = [*keys, "island"]
    rank = F.struct(F.col("cluster_size"), -F.col("start"), *[-F.col(o) for o in order])
    rest = [c for c in ("start", "stop", "svid", "seq", "start2") if c in islanded.columns]
    length = F.lit(0).cast("long") if translocations else F.max("sv_len")
    # one pick of all columns: rows that move to their island carry the rank once
    merged = islanded.groupBy(*ident).agg(F.max_by(F.struct(*rest), rank).alias("__f"), length.alias("sv_len"), F.floor(F.avg("maq")).cast("int").alias("maq"), F.sum("cluster_size").alias("cluster_size"), F.sum("sv_rate").alias("sv_rate"), *more)
    return merged.select(*ident, *[F.col("__f")[c].alias(c) for c in rest], *[c for c in merged.columns if c not in (*ident, "__f")])


def cohort_merge(islanded: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """Per island the most frequent value of each column on its own (the smallest of equals) and the mean quality
    rounded down; a row may so mix its members, as the cohort merge means it to."""
    return islanded.groupBy(*keys, "island").agg(*[F.mode(c, True).alias(c) for c in columns], F.floor(F.avg("maq")).cast("int").alias("maq"), F.count(F.lit(1)).alias("merged"))


def distinct_last(df: DataFrame, ident: str, order: list[str]) -> DataFrame:
    """One row of each identifier, the last in order."""
    return distinct_first(df, [ident], [F.desc(o) for o in order])


def mean_depth(coverage: DataFrame, sizes: DataFrame) -> DataFrame:
    """Per chromosome: size, mapped bases, depth to two places, and what follows from it."""
    mapped = coverage.groupBy("chrom").agg(F.sum(F.col("stop") - F.col("start")).alias("mapped"))
    joined = sizes.select("chrom", "size").join(mapped, "chrom", "left").withColumn("mapped", F.coalesce("mapped", F.lit(0)))
    depth = round_half_even(F.try_divide("mapped", "size"), 2)
    return joined.withColumns({"depth": depth, "threshold": F.ceil(depth + 0.3).cast("long"), "nreads": F.floor(depth / 10).cast("long")})


def probe_places(sv_type: Column, start: Column, size: Column) -> tuple[Column, Column]:
    """Where the depth around a breakpoint is read: before insertions and duplications, in the middle of others."""
    mid = F.floor(start + 0.5 * size).cast("long")
    side = sv_type.isin("INS", "DUP")
    return F.when(side, start - 70).otherwise(mid), F.when(side, start - 50).otherwise(mid + 20)


def accept(clusters: DataFrame, rate: float = 0.1, more: float = 1.0, nreads: int | None = None) -> DataFrame:
    """Clusters with support enough for their local depth (column depth, the probe's count; one is added), and rescued types;
    with nreads also those of nreads - 1 reads at least."""
    depth, reads, size = F.col("depth") + 1, F.col("reads"), F.col("sv_len")
    main = reads >= depth * rate + more
    rescue = (
        ((F.col("sv_type") == "INS") & (size > 3000) & (reads >= depth * rate * 0.6))
        | ((F.col("sv_type") == "DUP") & (size > 500) & (reads >= depth * rate * 0.5))
        | ((F.col("sv_type") == "INV") & (reads >= depth * rate * 0.5))
    )
    if nreads is not None:
        rescue = rescue | (reads >= nreads - 1)
    rescued = F.when(main, F.lit("main")).otherwise(F.lit("rescue"))
    return clusters.where((reads >= 2) & (main | rescue)).withColumns({"accepted": rescued, "sv_rate": round_half_even(reads / depth, 2)})


def accept_assembly(clusters: DataFrame, rate: float = 0.25) -> DataFrame:
    """Depth is the larger of both sides' (left_n, right_n); the share of reads must reach rate and a quarter."""
    depth = F.greatest("left_n", "right_n")
    return clusters.withColumn("sv_rate", F.when(depth == 0, 1.0).otherwise(round_half_even(F.col("reads") / depth, 2))).where(F.col("sv_rate") >= max(rate, 0.25))


def accept_fixed(clusters: DataFrame, rate: float = 0.1, more: float = 1.0) -> DataFrame:
    """Depth is the smaller of both sides'; insertions over 2000 need half."""
    depth, reads = F.least("left_n", "right_n"), F.col("reads")
    clusters = clusters.withColumn("sv_rate", round_half_even(reads / (depth + 1), 2))
    return clusters.where((reads >= depth * rate + more) | ((F.col("sv_type") == "INS") & (F.col("sv_len") > 2000) & (reads >= depth * rate * 0.5)))


def accept_breaks(clusters: DataFrame, nreads: int = 2) -> DataFrame:
    """Deletions without depth, or with clip ends at both breakpoints (break1_n, break2_n): their mean 2 at least, or with the reads nreads at least."""
    mean = (F.col("break1_n") + F.col("break2_n")) / 2
    return clusters.where(((F.col("sv_type") == "DEL") & (F.col("depth") == 0)) | (mean >= 2) | (mean + F.col("reads") >= nreads))


def accept_translocations(clusters: DataFrame, long_reads: bool = True) -> DataFrame:
    """Depth is the mean of both sides' (left_n, right_n)."""
    depth = (F.col("left_n") + F.col("right_n")) / 2
    return clusters.where(F.col("reads") >= 0.1 * depth + 0.7 if long_reads else F.col("reads") > 0.25 * depth)


def tolerance_name(rows: Column, sv_type: Column, platform: str, fixed: bool = False) -> Column:
    """Which tolerance a window uses: high above 5 rows for hifi and ont, above 10 for pb, always for assemblies and short reads.
    fixed: for windows of one width, high above 5 rows for hifi alone, above 10 for every other platform."""
    limit = (5 if platform == "hifi" else 10) if fixed else {"hifi": 5, "ont": 5, "pb": 10}.get(platform, -1)
    level = F.when(rows > limit, "high").otherwise("low")
    return F.when(sv_type == "INS", F.concat(level, F.lit("_ins"))).otherwise(level)


def least_rate(ploidy: int, platform: str = "hifi") -> float:
    return PLOIDY_RATE[1 if platform in ("cr", "sr") else min(ploidy, max(PLOIDY_RATE))]


def default_reads(depth: float) -> int:
    return math.floor(depth / 10)
