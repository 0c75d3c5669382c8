"""Nested variants, and coordinates in inverted sequence."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from strandmill.functions.scalars import reverse_complement
from strandmill.operators.intervals import levels, overlap_join
from strandmill.operators.runs import numbered_islands, settled
from strandmill.operators.windows import nested_apart

#: Outer and inner types that may nest; fixed values.
ALLOWED = {
    "cohort": [("DUP", "INV"), ("DUP", "DEL"), ("INV", "INS"), ("INV", "DEL"), ("INV", "DUP")],
    "genome": [("DUP", "INV"), ("DUP", "DEL"), ("INS", "INV"), ("INS", "DEL"), ("INV", "INS"), ("INV", "DEL"), ("INV", "DUP")],
    "near": [("DUP", "INV"), ("DUP", "DEL"), ("DUP", "INS"), ("INV", "INS"), ("INV", "DEL"), ("INV", "DUP"), ("INS", "INV"), ("INS", "DEL")],
}

#: Rows of a cluster that are paired in a list.
FEW = 64


def nested_pairs(variants: DataFrame, order: list[str], allowed: str = "genome", gap: int = 5000, near: int = 0, work: Callable[[DataFrame, list[str]], DataFrame] = lambda pairs, by: pairs.drop("__at")) -> DataFrame:
    """Pairs of one gap cluster whose outer variant contains the inner one (within near bases, then its sv_len must be
    larger) and whose types may nest. Columns o_ and i_ and the cluster. Rows of clusters of up to FEW are paired in lists, where
    they lie; those of larger ones, and of clusters over an edge of stretches, meet by an interval join. work is done to
    pairs of whole clusters, named by the keys handed to it and cluster."""
    own = [c for c in variants.columns if c != "chrom"]

    def nests(o: Callable[[str], Column], i: Callable[[str], Column]) -> Column:
        kinds = F.lit(False)
        for a, b in ALLOWED[allowed]:
            kinds = kinds | ((o("sv_type") == a) & (i("sv_type") == b))
        inside = (o("start") - near <= i("start")) & (o("stop") + near >= i("stop"))
        different = F.struct(*[o(c) for c in order]) != F.struct(*[i(c) for c in order])
        ordered = (o("start") - near <= o("stop") + near) & (i("start") <= i("stop"))  # else they meet none
        return kinds & inside & different & ordered & ((o("sv_len") > i("sv_len")) if near else F.lit(True))

    def listed(rows: DataFrame, by: list[str]) -> DataFrame:
        lists = rows.groupBy(*by, F.col("island").alias("cluster")).agg(F.collect_list(F.struct(*own)).alias("__l"))
        inner = lambda o: F.transform(F.filter("__l", lambda i: nests(o.getField, i.getField)), lambda i: F.struct(o.alias("o"), i.alias("i")))
        pairs = lists.select(*by, "cluster", F.explode(F.flatten(F.transform("__l", inner))).alias("p"))
        return pairs.select(*by, "cluster", *[F.col(f"p.o.{c}").alias("o_" + c) for c in own], *[F.col(f"p.i.{c}").alias("i_" + c) for c in own])

    def joined(rows: DataFrame) -> DataFrame:
        wide = rows.withColumns({"__low": F.col("start") - near, "__high": F.col("stop") + near})
        kept = nests(F.col, lambda c: F.col("r_" + c)) & (F.col("island") == F.col("r_island"))
        pairs = overlap_join(wide, rows, kept, ("chrom", "__low", "__high"), sizes=sizes)
        return pairs.select("chrom", F.col("island").alias("cluster"), *[F.col(c).alias("o_" + c) for c in own], *[F.col("r_" + c).alias("i_" + c) for c in own])

    known = variants.where(F.col("chrom").isNotNull())  # rows without a chromosome have no pair
    # levels of all rows, as those of the few rows that are joined would take another pass of the islands
    sizes = tuple(levels((known.withColumns({"__low": F.col("start") - near, "__high": F.col("stop") + near}), "__low", "__high"), (known, "start", "stop")))
    rows, by = numbered_islands(known, ["chrom"], ["start", *order], nested_apart(gap))
    counted = rows.withColumn("__n", F.count(F.lit(1)).over(Window.partitionBy(*by, "island")))
    apart = F.col("__over") | (F.col("__n") > FEW)
    few = work(listed(counted.where(~apart), by), by).drop("__at")
    many = work(joined(counted.where(apart).drop("__n", "__at", "__over")), ["chrom"])
    return few.unionByName(many)


def nested_consensus(pairs: DataFrame, order: list[str], by: tuple[str, ...] | list[str] = ("chrom",)) -> DataFrame:
    """One row per cluster: medians of the four ends, rounded down, types and lengths of the first pair."""
    mid = lambda c: F.floor(F.percentile(c, 0.5)).cast("long").alias(c)
    first = F.struct("o_start", *["o_" + o for o in order], "i_start", *["i_" + o for o in order])
    picked = ["o_sv_type", "o_sv_len", "i_sv_type", "i_sv_len"]  # picked at once, so that the order goes along once
    found = pairs.groupBy(*by, "cluster").agg(*map(mid, ("o_start", "o_stop", "i_start", "i_stop")), F.min_by(F.struct(*picked), first).alias("f"), F.count(F.lit(1)).alias("pairs"))
    return found.select(*by, "cluster", "o_start", "o_stop", "i_start", "i_stop", *[F.col(f"f.{c}").alias(c) for c in picked], "pairs")


def mirrored(start: Column, stop: Column, inv_start: Column, inv_stop: Column) -> tuple[Column, Column]:
    """An interval's place once the inversion is turned back."""
    total = inv_start + inv_stop
    return F.least(total - start, total - stop), F.greatest(total - start, total - stop)


def mirror(variants: DataFrame, inversions: DataFrame, ident: list[str], near: int = 10) -> DataFrame:
    """Variants whose start lies in an inversion (within near bases), at their mirrored places; the last
    inversion by start and stop wins. Others stay. ident names a variant."""
    inv = inversions.select("chrom", F.col("start").alias("inv_start"), F.col("stop").alias("inv_stop"), (F.col("start") - near).alias("low"), (F.col("stop") + near).alias("high"))
    hits = overlap_join(variants.select(*ident, "chrom", "start"), inv, None, ("chrom", "start", "start"), ("chrom", "low", "high"))
    last = hits.groupBy(*ident).agg(F.max(F.struct(F.col("r_inv_start").alias("a"), F.col("r_inv_stop").alias("b"))).alias("inv"))
    joined = variants.join(last, ident, "left")
    low, high = mirrored(F.col("start"), F.col("stop"), F.col("inv.a"), F.col("inv.b"))
    moved = F.col("inv").isNotNull()
    return joined.withColumns({"start": F.when(moved, low).otherwise(F.col("start")), "stop": F.when(moved, high).otherwise(F.col("stop")), "mirrored": moved}).drop("inv")


def mirror_contained(variants: DataFrame, inversions: DataFrame, ident: list[str]) -> DataFrame:
    """Variants wholly in inversions, mirrored by each that holds their current place, in order of the inversions' start.
    A mirrored variant stays within its inversion, so only inversions that overlap in a chain can follow each
    other: chains are islands of the inversions, and a variant is joined to the chain that it overlaps."""
    before = Window.partitionBy("chrom").orderBy("start", "stop").rowsBetween(Window.unboundedPreceding, -1)
    marked = inversions.select("chrom", "start", "stop").distinct().withColumn("__new", F.coalesce(F.col("start") > F.max("stop").over(before), F.lit(True)).cast("int"))
    chained = marked.withColumn("chain", F.sum("__new").over(Window.partitionBy("chrom").orderBy("start", "stop").rowsBetween(Window.unboundedPreceding, 0)))
    chains = chained.groupBy("chrom", "chain").agg(F.min("start").alias("start"), F.max("stop").alias("stop"), F.array_sort(F.collect_list(F.struct(F.col("start").alias("a"), F.col("stop").alias("b")))).alias("invs"))
    inside = (F.col("start") >= F.col("r_start")) & (F.col("stop") <= F.col("r_stop"))
    listed = overlap_join(variants.select(*ident, "chrom", "start", "stop"), chains, inside).select(*ident, F.col("r_invs").alias("invs"))

    def step(at: Column, i: Column) -> Column:
        low, high = mirrored(at["start"], at["stop"], i["a"], i["b"])
        held = (at["start"] >= i["a"]) & (at["stop"] <= i["b"])
        return F.struct(F.when(held, low).otherwise(at["start"]).alias("start"), F.when(held, high).otherwise(at["stop"]).alias("stop"))

    folded = F.aggregate(F.coalesce("invs", F.array().cast("array<struct<a:bigint,b:bigint>>")), F.struct(F.col("start").cast("long").alias("start"), F.col("stop").cast("long").alias("stop")), step)
    return variants.join(listed, ident, "left").withColumn("__at", folded).withColumns({"start": F.col("__at.start"), "stop": F.col("__at.stop")}).drop("__at", "invs")


def invert_sequences(sequences: DataFrame, inversions: DataFrame) -> DataFrame:
    """sequences: chrom, seq. Each [start, stop) slice, counted from 0, is replaced by its reverse complement, from the last to the first."""
    listed = inversions.groupBy("chrom").agg(F.reverse(F.array_sort(F.collect_set(F.struct("start", "stop")))).alias("invs"))

    def step(s: Column, i: Column) -> Column:
        size = (i["stop"] - i["start"]).cast("int")
        at = (i["start"] + 1).cast("int")
        return F.overlay(s, reverse_complement(F.substring(s, at, size)), at)

    joined = sequences.join(listed, "chrom", "left")
    return joined.withColumn("seq", F.when(F.col("invs").isNull(), F.col("seq")).otherwise(F.aggregate(F.coalesce("invs", F.array().cast("array<struct<start:bigint,stop:bigint>>")), F.col("seq"), step))).drop("invs")


def until_stable(call: Callable[[DataFrame], DataFrame], sequences: DataFrame, rounds: int = 10, invert: Callable[[DataFrame, DataFrame], DataFrame] = invert_sequences) -> tuple[DataFrame, list[DataFrame]]:
    """Calls variants, inverts the sequences at the inversions found and calls again, until there are none or
    not fewer than before. Returns the sequences and each round's variants. Each round's variants and sequences are
    checkpointed, so a round reads what the last one left. invert: of whole sequences, or sequences.inverted of chunks."""
    found, before = [], None
    for _ in range(rounds):
        variants = settled(call(sequences))
        found.append(variants)
        inversions = variants.where("sv_type = 'INV'")
        count = inversions.count()
        if not count or (before is not None and count >= before):
            break
        before = count
        sequences = settled(invert(sequences, inversions))
    return sequences, found


def turned_back(variants: DataFrame, inversions: list[DataFrame], ident: list[str], near: int = 10) -> DataFrame:
    """Variants of inverted sequences at their places in the sequence of the first round: mirrored by each round's
    inversions, from the first round on."""
    for table in inversions:
        variants = mirror(variants, table, ident, near).drop("mirrored")
    return variants


def joined_rounds(found: list[DataFrame], merge: Callable[[DataFrame], DataFrame], ident: list[str]) -> DataFrame:
    """The variants of all rounds of until_stable() as one table, merged by merge(), at their places in the first round's
    sequence. The last round's inversions were not inverted, so they turn nothing back."""
    table = found[0]
    for more in found[1:]:
        table = table.unionByName(more)
    return turned_back(merge(table), [f.where("sv_type = 'INV'") for f in found[:-1]], ident)
