"""Connected components of an edge table by alternating large-star and small-star steps, and joins that split hot keys."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandmill.llm.shared import cut

#: A key with more than one HUBS-th of a table's rows is joined by broadcast; there are fewer than HUBS of those.
HUBS = 256


def split_join(left: DataFrame, right: DataFrame, key: str, total: int) -> DataFrame:
    """left joined to right on key. right has one row of each key with rows_of_key, the number of its rows in left, or more;
    total: the number of rows of left, or more. Keys with many rows, fewer than HUBS by that count, are broadcast; a task
    of the other join meets no key of more than total / HUBS rows."""
    limit = total // HUBS
    hubs = F.broadcast(right.where(F.col("rows_of_key") > limit).drop("rows_of_key"))
    rest = right.where(F.col("rows_of_key") <= limit).drop("rows_of_key")
    return left.join(hubs, key).unionByName(left.join(hubs.select(key), key, "left_anti").join(rest, key))


def connected(edges: DataFrame) -> DataFrame:
    """edges: u, v, of one ordered type. Returns node, root (its component's smallest node) for nodes that
    have an edge to another; self-loops and repeated edges do no harm; no edges give no rows.

    Each step is an aggregate that is combined by task and a join back that splits hubs, so no
    neighbourhood is ever collected."""
    n = F.count(F.lit(1)).alias("rows_of_key")
    found = cut(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    count, before = found.count(), None
    while True:
        # large star: of each node, the larger neighbours are tied to the smallest neighbour or itself; u > v in every edge
        upward = found.select(F.col("v").alias("u"), F.col("u").alias("v"))
        ends = found.select("u", "v", F.lit(0).alias("n")).union(found.select(F.col("v").alias("u"), "v", F.lit(1).alias("n")))
        least = ends.groupBy("u").agg(F.min("v").alias("m"), F.sum("n").alias("rows_of_key"))
        large = cut(split_join(upward, least, "u", count).select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        # small star: a node's smaller neighbours, and it, are tied to the smallest
        least = large.groupBy("u").agg(F.min("v").alias("m"), n)
        small = split_join(large, least, "u", count).where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        found = cut(small.union(least.select("u", F.col("m").alias("v"))).distinct())
        now = tuple(found.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).head())
        if now == before:
            break
        count, before = now[0], now
    return found.select(F.col("u").alias("node"), F.col("v").alias("root")).union(found.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
