"""Mixing sources to target weights by Pareto order sampling.

Targets: the sources share all words by weight; a target stops at `cap` times its source's size and
the excess is shared again by weight until none is above. A document's inclusion is r copies, r
being its source's target over size (times its own weight, if a weight column is given, scaled to
the source's target): floor(r) certain whole copies, and one more for a sample of fixed size in
words, drawn with inclusion odds p / (1 - p), p = r - floor(r): documents are ranked by random odds
u / (1 - u) over inclusion odds, smallest first, up to the words that the target leaves.

The ranking needs no sort of a source: ranks are counted in BINS bins of the rank value per source,
bins wholly below the cut are taken, and only the bin that holds the cut is sorted.

Defined results: a null text has size 0 and takes 0; a null source is a source of its own, last in
order; a source of size 0 has target 0; repeated rows are separate documents that share their random
number; random numbers come from doc_id, text and the seed alone, so reruns agree, and documents of null or
repeated ids are ranked apart.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType
from pyspark.sql.window import Window

from strandmill.llm.shared import SPACE, cut

BINS = 4096


def word_count(text: Column) -> Column:
    """Number of words: characters left when each word shrinks to one and separators go."""
    return F.coalesce(F.length(F.regexp_replace(F.regexp_replace(text, rf"[^{SPACE}]+", "x"), rf"[{SPACE}]+", "")), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, cap: float = 3.0, share: float = 1.0, weights: tuple[float, ...] = (1.0, 2.0, 3.0)) -> DataFrame:
    """sizes: source, source_size, one row each. Adds weight and target.

    Sources in code point order, null last, have weights repeating. Each round is one aggregate over
    the sources; the driver holds sums alone."""
    ordered = sizes.orderBy(F.col("source").asc_nulls_last())
    schema = StructType([*ordered.schema.fields, StructField("position", LongType())])
    placed = ordered.rdd.zipWithIndex().map(lambda x: (*x[0], x[1])).toDF(schema)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("position") % len(weights) + 1).cast("int"))
    table = cut(placed.withColumns({"weight": weight, "most": F.col("source_size") * cap}).drop("position"))
    wanted = share * float(table.agg(F.coalesce(F.sum("source_size"), F.lit(0)).alias("s")).head()["s"])
    level, capped = 0.0, -1
    while True:
        got = table.agg(
            F.coalesce(F.sum(F.when(F.col("weight") * level >= F.col("most"), F.col("most"))), F.lit(0.0)).alias("full"),
            F.coalesce(F.sum(F.when(F.col("weight") * level < F.col("most"), F.col("weight"))), F.lit(0.0)).alias("open"),
            F.count(F.when(F.col("weight") * level >= F.col("most"), 1)).alias("n"),
        ).head()
        if got["n"] == capped or not got["open"]:
            break
        capped, level = got["n"], (wanted - got["full"]) / got["open"]
    return table.withColumn("target", F.least("most", F.col("weight") * F.lit(level)).cast("double")).drop("most")


def mix(docs: DataFrame, text_col: str = "text", source_col: str = "source", id_col: str = "doc_id", cap: float = 3.0, share: float = 1.0, weights: tuple[float, ...] = (1.0, 2.0, 3.0), seed: int = 17, weight_col: str | None = None, keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per document: id, size, source_size, target, copies, taken; keep: further input columns.

    With weight_col (null or negative: 0) expected copies follow it within a source, up to cap."""
    own = F.coalesce(F.greatest(F.col(weight_col).cast("double"), F.lit(0.0)), F.lit(0.0)) if weight_col else F.lit(1.0)
    hashed = F.xxhash64(F.col(id_col).cast("string"), F.xxhash64(F.col(text_col)), F.lit(seed))
    rows = docs.select(
        F.struct(F.col(id_col).alias("id"), *[F.col(c) for c in keep]).alias("row"), F.col(source_col).alias("source"), word_count(F.col(text_col)).alias("size"), own.alias("own"),
        ((F.shiftrightunsigned(hashed, 11).cast("double") + 0.5) / F.lit(float(1 << 53))).alias("u"),
    )
    if not keep:
        rows = cut(rows)  # texts are read once
    targets = source_targets(rows.groupBy("source").agg(F.sum("size").alias("source_size")), cap, share, weights).withColumnRenamed("source", "of")
    joined = rows.join(F.broadcast(targets) if targets.count() <= 100_000 else targets, F.col("source").eqNullSafe(F.col("of")), "left").drop("of")
    if weight_col:
        joined = _scaled(joined, cap)
    else:
        joined = joined.withColumn("r", F.when(F.col("source_size") > 0, F.least(F.col("target") / F.col("source_size"), F.lit(float(cap)))).otherwise(0.0))
    split = joined.withColumns({"whole": F.floor("r").cast("long"), "p": F.col("r") - F.floor("r")})
    odds = (F.col("u") / (1 - F.col("u"))) / (F.col("p") / (1 - F.col("p")))
    split = split.withColumn("q", F.when((F.col("p") > 0) & (F.col("size") > 0), odds))
    split = split.withColumn("bin", F.when(F.col("q").isNotNull(), F.floor(BINS * F.col("q") / (1 + F.col("q"))).cast("int")))
    counted = split.groupBy("source", "bin").agg(F.sum("size").alias("bin_size"), F.sum(F.col("whole") * F.col("size")).alias("sure"), F.max("target").alias("goal"))
    by = Window.partitionBy("source")
    up_to = F.sum(F.when(F.col("bin").isNotNull(), F.col("bin_size")).otherwise(0)).over(by.orderBy("bin").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    bins = counted.withColumns({"room": F.max("goal").over(by) - F.sum("sure").over(by), "below": up_to - F.col("bin_size")})
    cuts = bins.where("bin is not null and below < room and below + bin_size >= room").select(F.col("source").alias("of"), F.col("bin").alias("cut_bin"), "room", "below")
    # no such bin: nothing is left to draw, or all bins with a rank are taken
    few = cuts.count() <= 100_000
    rooms = bins.groupBy("source").agg(F.max("room").alias("all_room"), F.sum(F.when(F.col("bin").isNotNull(), F.col("bin_size")).otherwise(0)).alias("all_size")).withColumnRenamed("source", "of2")
    marked = split.join(F.broadcast(cuts) if few else cuts, F.col("source").eqNullSafe(F.col("of")), "left").drop("of")
    marked = marked.join(F.broadcast(rooms) if few else rooms, F.col("source").eqNullSafe(F.col("of2")), "left").drop("of2")
    at_cut = marked.where(F.col("bin") == F.col("cut_bin"))
    rank = Window.partitionBy("source").orderBy("q", F.xxhash64("u", "size"), "size").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    at_cut = at_cut.withColumn("through", F.col("below") + F.sum("size").over(rank)).withColumn("more", (F.abs(F.col("through") - F.col("room")) <= F.abs(F.col("through") - F.col("size") - F.col("room"))).cast("long"))
    rest = marked.where(F.col("bin").isNull() | F.col("cut_bin").isNull() | (F.col("bin") != F.col("cut_bin")))
    rest = rest.withColumn("more", F.when(F.col("q").isNull(), 0).when(F.col("cut_bin").isNotNull(), (F.col("bin") < F.col("cut_bin")).cast("int")).otherwise((F.col("all_size") <= F.col("all_room")).cast("int")).cast("long"))
    both = rest.drop("through").unionByName(at_cut.drop("through")).withColumn("copies", F.col("whole") + F.col("more"))
    return both.select(F.col("row.id").alias(id_col), *[F.col(f"row.{c}").alias(c) for c in keep], "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"))


def _scaled(joined: DataFrame, cap: float, rounds: int = 12) -> DataFrame:
    """Adds r, expected copies: least(cap, c * own); c of each source from rounds that share again what capped documents leave."""
    levels = joined.groupBy("source").agg(F.max("target").alias("goal"), F.sum(F.col("own") * F.col("size")).alias("open")).select(F.col("source").alias("of"), "goal", (F.col("goal") / F.col("open")).alias("c"))
    for _ in range(rounds):
        full = F.col("c") * F.col("own") >= cap
        again = joined.select("source", "size", "own").join(levels, F.col("source").eqNullSafe(F.col("of")))
        levels = cut(
            again.groupBy("of").agg(F.max("goal").alias("goal"), F.max("c").alias("c"), F.coalesce(F.sum(F.when(full, F.col("size") * cap)), F.lit(0.0)).alias("full"), F.sum(F.when(~full, F.col("own") * F.col("size"))).alias("open"))
            .select("of", "goal", F.when(F.col("open") > 0, (F.col("goal") - F.col("full")) / F.col("open")).otherwise(F.col("c")).alias("c"))
        )
    return joined.join(levels.drop("goal"), F.col("source").eqNullSafe(F.col("of")), "left").withColumn("r", F.coalesce(F.least(F.col("c") * F.col("own"), F.lit(float(cap))), F.lit(0.0))).drop("of", "c")
