"""Cohort tables: merging samples, phasing, imputation, frequencies."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from strandmill.operators.runs import placed


def cohort_matrix(long: DataFrame, samples: list[str], ident: str = "id", fixed: tuple[str, ...] = ("chrom", "pos")) -> DataFrame:
    """One row per variant over all samples, "./." where a sample has none; fixed columns come from the
    first sample that has the variant. The sample list is given, so no job looks for it."""
    first = [F.min_by(c, "sample").alias(c) for c in fixed]
    calls = [F.coalesce(F.max(F.when(F.col("sample") == s, F.col("gt"))), F.lit("./.")).alias(s) for s in samples]
    return long.groupBy(ident).agg(*first, *calls)


def cohort_arrays(long: DataFrame, samples: DataFrame, ident: str = "id", fixed: tuple[str, ...] = ("chrom", "pos"), usual: str = "./.", sparse: bool = False) -> DataFrame:
    """cohort_matrix() for any number of samples (samples: sample, place from 1, one row each): one row per variant with calls, the
    samples' calls in order of place, usual where a sample has none; of several calls of a sample the largest. The plan
    has as many columns for twenty thousand samples as for two.

    sparse: calls holds only (place, gt) of those other than usual, as "0/0" in cohorts where most are."""
    table = F.broadcast(samples) if samples.count() <= 100_000 else samples
    own = long.join(table.select("sample", F.col("place").cast("int").alias("place")), "sample").groupBy(ident, "place").agg(
        F.max("gt").alias("gt"), *[F.min_by(c, "sample").alias(c) for c in fixed], F.min("sample").alias("sample"))
    listed = own.groupBy(ident).agg(*[F.min_by(c, "sample").alias(c) for c in fixed], F.array_sort(F.collect_list(F.struct("place", F.coalesce("gt", F.lit(usual)).alias("gt")))).alias("__l"))
    if sparse:
        return listed.withColumn("calls", F.filter("__l", lambda x: x["gt"] != usual)).drop("__l")
    count = samples.agg(F.coalesce(F.max("place"), F.lit(0)).alias("n")).head()["n"]
    gap = lambda n: F.array_repeat(F.lit(usual), n.cast("int"))
    before = F.concat(F.array(F.lit(0)), F.transform("__l", lambda x: x["place"]))
    parts = F.zip_with("__l", F.slice(before, 1, F.size("__l")), lambda x, b: F.concat(gap(x["place"] - b - 1), F.array(x["gt"])))
    calls = F.concat(F.flatten(parts), gap(F.lit(count) - F.element_at("__l", -1)["place"]))
    return listed.withColumn("calls", calls).drop("__l")


def in_order(matrix: DataFrame, as_text: bool = False) -> DataFrame:
    """By chromosome and position; as_text sorts positions as strings, as some readers of such files expect."""
    pos = F.col("pos").cast("string") if as_text else F.col("pos").cast("long")
    return matrix.orderBy("chrom", pos, "id")


#: One haplotype's call from a diploid call, and diploid spellings of phased ones; fixed values.
HAPLOTYPE = {"1/1": "1", "0/0": "0", "./.": ".", "0/1": "0/1"}
PHASED = {"0/1|1": "0|1", "0/1|0": "1|0", "0|0/1": "0|1", "1|0/1": "1|0", "0/1|0/1": "0/1"}


def _mapped(value: Column, table: dict[str, str]) -> Column:
    out = F.lit(None)
    for key, to in table.items():
        out = F.when(value == key, to).otherwise(out)
    return F.coalesce(out, value)


def phase_two(first: DataFrame, second: DataFrame, keys: list[str]) -> DataFrame:
    """Joins two haplotypes' calls (gt) by variant; a variant of one haplotype alone has "." on the other side."""
    both = first.select(*keys, F.col("gt").alias("a")).join(second.select(*keys, F.col("gt").alias("b")), keys, "full")
    hap = lambda c: _mapped(F.coalesce(c, F.lit("./.")), HAPLOTYPE)
    return both.select(*keys, _mapped(F.concat(hap(F.col("a")), F.lit("|"), hap(F.col("b"))), PHASED).alias("gt"))


def phase_positional(first: DataFrame, second: DataFrame, order: list[str], keep: list[str]) -> DataFrame:
    """phase_two() of tables without common keys: the n-th row of one, in order, meets the n-th of the other. Rows are numbered in
    ranges, so no task sorts a whole table. keep: columns of the first one's rows; rows that one table alone has get "."."""
    a = placed(first, order, "__place").select("__place", *keep, F.col("gt").alias("a"))
    b = placed(second, order, "__place").select("__place", F.col("gt").alias("b"))
    hap = lambda c: _mapped(F.coalesce(c, F.lit("./.")), HAPLOTYPE)
    both = a.join(b, "__place", "full")
    return both.select(F.col("__place").alias("place"), *keep, _mapped(F.concat(hap(F.col("a")), F.lit("|"), hap(F.col("b"))), PHASED).alias("gt"))


def standard_call(phased: Column) -> Column:
    """A polyploid call a|b|c... as a diploid one."""
    has = lambda x: F.array_contains(F.split(phased, r"\|"), x)
    return (
        F.when(has("0") & has("1"), "0/1").when(has("1"), "1/1").when(has("0") & has("."), "./0").when(~has("."), "0/0")
        .otherwise(F.array_join(F.array_distinct(F.split(phased, r"\|")), "."))
    )


def phase_many(haplotypes: DataFrame, keys: list[str]) -> DataFrame:
    """haplotypes: keys, hap (its number), gt. Per variant the haplotypes' calls in order, joined by |, and as a diploid call.
    Heterozygous calls of one haplotype count as 0."""
    call = F.when(F.col("gt") == "1/1", "1").when(F.col("gt").isin("0/0", "0/1"), "0").otherwise(".")
    joined = haplotypes.groupBy(*keys).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("hap", call.alias("c")))), lambda x: x["c"]), "|").alias("phased"))
    return joined.withColumn("gt", standard_call(F.col("phased")))


def missing_rate(calls: list[Column], metadata: int = 0) -> Column:
    """Share of missing calls; metadata counts further columns of the row as calls."""
    missing = sum((F.when(c.isNull() | c.isin(".", "./."), 1).otherwise(0) for c in calls), F.lit(0))
    return missing / (len(calls) + metadata)


def homozygous_frequency(long: DataFrame, keys: list[str]) -> DataFrame:
    return long.groupBy(*keys).agg(F.avg(F.when(F.col("gt") == "1/1", 1.0).otherwise(0.0)).alias("maf"), F.count(F.lit(1)).alias("n"))


def impute(long: DataFrame, keys: list[str], order: list[str], k: int = 5, exclude_target: bool = True, by: tuple[str, ...] = ()) -> DataFrame:
    """long: keys (a variant), sample, gt. A missing call takes the first sample's that has the same calls at the k
    variants before and after (in order, within by) and a call itself.

    exclude_target=False also compares the calls at the variant, so that a missing call only ever meets missing
    ones: the way of the plain identity clustering, which fills nothing."""
    frame = Window.partitionBy(*by, "sample").orderBy(*order).rowsBetween(-k, k)
    code = F.coalesce(F.col("gt"), F.lit("./."))
    place = F.row_number().over(Window.partitionBy(*by, "sample").orderBy(*order))
    seen = long.withColumn("__at", place).withColumn("__calls", F.collect_list(F.struct(F.col("__at").alias("at"), code.alias("gt"))).over(frame))
    around = F.filter("__calls", lambda x: x["at"] != F.col("__at")) if exclude_target else F.col("__calls")
    seen = seen.withColumn("__pattern", F.array_join(F.transform(around, lambda x: x["gt"]), ","))
    known = ~F.col("gt").isin(".", "./.") & F.col("gt").isNotNull()
    donors = seen.where(known).groupBy(*by, *keys, "__pattern").agg(F.min_by("gt", "sample").alias("__donor"))
    filled = seen.join(donors, [*by, *keys, "__pattern"], "left")
    return filled.withColumn("imputed", F.when(known, F.col("gt")).otherwise(F.coalesce("__donor", F.lit("./.")))).drop("__at", "__calls", "__pattern", "__donor")


#: Variants that a task orders together, besides the neighbours of the first and last ones.
BLOCK = 1024
#: Bits of a call: reference, homozygous, heterozygous; a missing one has none. Fixed values.
BITS = {"0/0": 0, "1/1": 1, "0/1": 2, "1/0": 2}


def patterns(long: DataFrame, ident: list[str], order: list[str], k: int = 5, by: tuple[str, ...] = (), block: int = BLOCK) -> DataFrame:
    """long (ident, sample, gt) with pattern: the sample's calls at the k variants before, at, and the k after, in order within by.
    Variants are numbered once; a sample's rows are dealt in blocks of variants, with k more on both sides, so a
    sample of a long chromosome is many tasks' work. Variants without a call of the sample are missing ones. One row of each variant
    and sample."""
    variants = long.select(*by, *dict.fromkeys([*ident, *order])).distinct()
    numbered = placed(variants, [*by, *order], "__all")
    if by:
        first = numbered.groupBy(*by).agg(F.min("__all").alias("__first"))
        numbered = numbered.join(first, list(by)).withColumn("__at", F.col("__all") - F.col("__first")).drop("__first", "__all")
    else:
        numbered = numbered.withColumn("__at", F.col("__all") - 1).drop("__all")
    rows = long.select(*by, *ident, "sample", "gt").join(numbered.select(*by, *ident, "__at"), [*by, *ident])
    spread = rows.withColumn("__block", F.explode(F.sequence(F.floor((F.col("__at") - k) / block), F.floor((F.col("__at") + k) / block)))).where("__block >= 0 or __at < 0")
    names = [*by, "__block", "sample"]
    listed = spread.groupBy(*names).agg(F.map_from_entries(F.collect_set(F.struct("__at", "gt"))).alias("__calls"), F.array_sort(F.collect_set("__at")).alias("__places"))
    asked = listed.withColumn("__at", F.explode("__places")).where(F.floor(F.col("__at") / block) == F.col("__block"))
    around = F.transform(F.sequence(F.lit(-k), F.lit(k)), lambda d: F.coalesce(F.try_element_at("__calls", F.col("__at") + d), F.lit("./.")))
    found = asked.withColumn("pattern", around).select(*by, "__at", "sample", F.try_element_at("__calls", F.col("__at")).alias("gt"), "pattern")
    return found.join(numbered, [*by, "__at"]).drop("__at")


def clustered(bits: np.ndarray, clusters: int) -> np.ndarray:
    """Cluster number of each row of bits: rows begin alone, and the two clusters of the smallest mean number of differing bits become one
    until there are clusters; of equal ones the first two by their first rows. Distances stay sums, so equal means are equal numbers."""
    n = len(bits)
    total = (bits[:, None, :] != bits[None, :, :]).sum(2).astype(np.float64)
    size, owner = np.ones(n), np.arange(n)
    alive = np.ones(n, bool)
    mean = total.copy()
    mean[np.tril_indices(n)] = np.inf
    nearest = mean.argmin(1)
    best = mean[np.arange(n), nearest]
    for _ in range(n - max(1, clusters)):
        a = int(best.argmin())
        b = int(nearest[a])
        owner[owner == b] = a
        total[a] += total[b]
        total[:, a] = total[a]
        size[a] += size[b]
        alive[b] = False
        mean[b], mean[:, b], best[b] = np.inf, np.inf, np.inf
        live = np.flatnonzero(alive)
        own = total[a, live] / (size[a] * size[live])
        mean[a, live[live > a]] = own[live > a]
        mean[live[live < a], a] = own[live < a]
        again = live[(live == a) | (live < a) | (nearest[live] == b)]
        nearest[again] = mean[again].argmin(1)
        best[again] = mean[again, nearest[again]]
    return owner


def impute_clusters(long: DataFrame, ident: list[str], order: list[str], clusters: int, k: int = 5, by: tuple[str, ...] = (), most_missing: float = 1.0, metadata: int = 5, block: int = BLOCK) -> DataFrame:
    """Missing calls of a variant take the first known call, by sample, of the cluster that the sample's pattern falls in. The distinct
    patterns (calls at the k variants before and after, and at the variant) are clustered by the mean number of bits in which
    they differ (three a call, none set if it is missing) until there are clusters. Only variants with a missing call
    and a share of missing ones, of the samples and metadata further columns, of most_missing at most are worked on; a variant's
    distinct patterns, as many as it has samples at most, are one task's work."""
    seen = patterns(long, ident, order, k, by, block)
    bits = {call: [float(j == bit) for j in range(3)] for call, bit in BITS.items()}

    def fill(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("sample", kind="stable")
        gt = group["gt"].where(group["gt"].notna() & (group["gt"] != "."), "./.").to_numpy(object)
        missing = gt == "./."
        out = gt.copy()
        if missing.any() and missing.sum() / (len(gt) + metadata) <= most_missing:
            codes, back = np.unique([",".join(p) for p in group["pattern"]], return_inverse=True)
            rows = np.array([[b for call in code.split(",") for b in bits.get(call, [0.0, 0.0, 0.0])] for code in codes])
            cluster = clustered(rows, clusters)[back]
            for c in np.unique(cluster[missing]):
                known = np.flatnonzero((cluster == c) & ~missing)
                if len(known):
                    out[(cluster == c) & missing] = gt[known[0]]
        return group.drop(columns="pattern").assign(imputed=out)

    names = [*by, *ident]
    kinds = dict(seen.dtypes)
    columns = [c for c in seen.columns if c != "pattern"]
    return seen.groupBy(*names).applyInPandas(lambda g: fill(g)[[*columns, "imputed"]], ", ".join([f"`{c}` {kinds[c]}" for c in columns] + ["imputed string"]))
