"""Ordered work on rows of a key: islands by window functions, and folds streamed over sorted partitions."""

from __future__ import annotations

import tempfile
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


#: Islands are marked in stretches of 2 to this power of places at most, where a key has more rows than PLAIN.
STRETCH, PLAIN = 20, 100_000
#: Stretches whose numbers are broadcast.
TOLD = 200_000


def settled(df: DataFrame) -> DataFrame:
    """df with its lineage cut by a reliable checkpoint in the folder that driver and executors share: spark.checkpoint.dir,
    or, only where that is unset (tests, one machine), a temporary folder."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(df.sparkSession.conf.get("spark.checkpoint.dir", None) or "file://" + tempfile.mkdtemp(prefix="strandmill-"))
    return df.checkpoint()


def placed(df: DataFrame, order: list[str], name: str = "place") -> DataFrame:
    """df with name, each row's place in order, from 1: rows are sorted in ranges, and the ranges' counts, one number a
    range, give where each begins. Equal rows have no fixed order among them."""
    dealt = settled(df.repartitionByRange(*order).sortWithinPartitions(*order)).withColumn("__part", F.spark_partition_id())
    counts = {r["__part"]: r["count"] for r in dealt.groupBy("__part").count().collect()}
    starts = dict(zip(sorted(counts), np.append(0, np.cumsum([counts[k] for k in sorted(counts)])).tolist()))
    first = F.create_map(*[F.lit(x) for k, v in starts.items() for x in (k, v)]) if starts else F.create_map(F.lit(0), F.lit(0))
    # monotonically_increasing_id counts rows within a partition from its number shifted by 33
    inner = F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)
    return dealt.withColumn(name, (first[F.col("__part")] + inner + 1).cast("long")).drop("__part")


def islands(df: DataFrame, keys: list[str], order: list[str], starts: Callable[[Callable[[str], Column]], Column], name: str = "island", stretch: int = STRETCH, plain: int = PLAIN) -> DataFrame:
    """Numbers runs from 1 within keys: a row for which starts(previous) is true or null begins a run;
    previous(column) is that column's value in the row before. order begins with a whole-number place.

    Where no key has more than plain rows, which a count by key tells, a window over each key does it. Beyond that a task
    sorts one stretch of places, not a key's rows: runs are marked within stretches, of a length at which the largest key's
    hold about plain rows, and the first and last row of each stretch, with its number of runs, carry marks and numbers over
    the edges. Both ways give the same rows."""
    return numbered_islands(df, keys, order, starts, name, stretch, plain)[0].drop("__at", "__over")


def by_island(df: DataFrame, keys: list[str], order: list[str], starts: Callable[[Callable[[str], Column]], Column], work: Callable[[DataFrame, list[str]], DataFrame], name: str = "island", stretch: int = STRETCH, plain: int = PLAIN) -> DataFrame:
    """work(rows of islands(), keys) for whole islands, which are groups of the keys handed to work and name. Islands within
    a stretch are grouped where they were numbered and do not move again; those that reach over an edge of stretches, few
    rows, are gathered apart."""
    numbered, by = numbered_islands(df, keys, order, starts, name, stretch, plain)
    if by == keys:
        return work(numbered.drop("__over"), keys)
    inner = work(numbered.where(~F.col("__over")).drop("__over"), by)
    over = work(numbered.where("__over").drop("__over", "__at"), keys)
    return inner.drop("__at").unionByName(over)


def numbered_islands(df: DataFrame, keys: list[str], order: list[str], starts: Callable[[Callable[[str], Column]], Column], name: str = "island", stretch: int = STRETCH, plain: int = PLAIN) -> tuple[DataFrame, list[str]]:
    """islands() with __over, whether a row's island reaches over an edge of stretches, and the columns by which rows lie in
    tasks: keys or, in stretches, keys and __at, a row's stretch."""
    far = F.coalesce(F.max(order[0]) - F.min(order[0]), F.lit(0)).cast("long")
    sizes = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"), far.alias("__far"))
    largest, many, length = sizes.agg(F.max(F.struct("__n", "__far")), F.count(F.lit(1)), F.sum(F.col("__far").cast("double"))).head()
    if largest is None or largest["__n"] <= plain:
        along = Window.partitionBy(*keys).orderBy(*order)
        new = F.coalesce(starts(lambda c: F.lag(c).over(along)), F.lit(True)).cast("int")
        marked = df.withColumn("__new", new)
        return marked.withColumn(name, F.sum("__new").over(along.rowsBetween(Window.unboundedPreceding, Window.currentRow))).drop("__new").withColumn("__over", F.lit(False)), keys
    if largest["__far"]:  # rows lie as densely as they do in the largest key
        stretch = min(stretch, max(0, int(np.log2(max(1.0, float(largest["__far"]) * plain / largest["__n"])))))
    place = F.coalesce(F.shiftright(F.col(order[0]).cast("long"), stretch), F.lit(-(1 << 62)))
    by = Window.partitionBy(*keys, "__at").orderBy(*order)
    inner = F.coalesce(starts(lambda c: F.lag(c).over(by)), F.lit(True)).cast("int")
    local = df.withColumn("__at", place)
    local = local.withColumns({"__first": F.row_number().over(by) == 1, "__last": F.lead(F.lit(1)).over(by).isNull(), "__new": inner})
    local = local.withColumn("__new", F.when(F.col("__first"), 0).otherwise(F.col("__new")))
    local = local.withColumn("__run", F.sum("__new").over(by.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    # only the columns that starts() reads are carried; a stretch's first row follows the last one of the stretch before
    over = Window.partitionBy(*keys).orderBy("__at", F.desc("__first"))
    ends = local.where(F.col("__first") | F.col("__last")).withColumn("__opens", F.coalesce(starts(lambda c: F.lag(c).over(over)), F.lit(True)).cast("int"))
    table = ends.groupBy(*keys, "__at").agg(F.max("__run").alias("__runs"), F.max(F.when(F.col("__first"), F.col("__opens"))).alias("__opens"))
    along = Window.partitionBy(*keys).orderBy("__at")
    until = F.sum(F.col("__opens") + F.col("__runs")).over(along.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    goes_on = F.coalesce(F.lead("__opens").over(along) == 0, F.lit(False))
    mine = [f"__key{i}" for i in range(len(keys) + 1)]
    told = [(until - F.col("__runs")).alias("__before"), "__runs", (F.col("__opens") == 0).alias("__came"), goes_on.alias("__goes")]
    table = table.select(*[F.col(k).alias(m) for k, m in zip([*keys, "__at"], mine)], *told)
    if 2 * many + length / 2.0**stretch <= TOLD:  # no more stretches than that
        table = F.broadcast(table)
    same = [F.col(k).eqNullSafe(F.col(m)) for k, m in zip([*keys, "__at"], mine)]
    joined = local.join(table, same).withColumn(name, F.col("__before") + F.col("__run"))
    crosses = ((F.col("__run") == 0) & F.col("__came")) | ((F.col("__run") == F.col("__runs")) & F.col("__goes"))
    return joined.withColumn("__over", crosses).drop(*mine, "__first", "__last", "__new", "__run", "__runs", "__before", "__came", "__goes"), [*keys, "__at"]


def map_runs(df: DataFrame, keys: list[str], order: list[str], work: Callable[[pd.DataFrame], pd.DataFrame], schema: str) -> DataFrame:
    """work on all rows of each value of keys, in order. Rows are dealt by key and sorted in their
    partition; whole runs are gathered from the stream and handed over together, so many small runs
    cost one call and memory is bounded by a batch and the largest run. work gets a column __run."""

    def stream(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rest: pd.DataFrame | None = None
        count = 0

        def number(part: pd.DataFrame, first: int) -> pd.DataFrame:
            k = part[keys]
            new = (k != k.shift()).any(axis=1).to_numpy()
            new[0] = True
            return part.assign(__run=first + np.cumsum(new))

        for batch in batches:
            if not len(batch):
                continue
            part = batch if rest is None else pd.concat([rest, batch], ignore_index=True)
            part = number(part, count)
            last = part["__run"].iloc[-1]
            whole = part[part["__run"] != last]
            rest = part[part["__run"] == last].drop(columns="__run")
            count = int(last)
            if len(whole):
                yield work(whole.reset_index(drop=True))
        if rest is not None and len(rest):
            yield work(number(rest.reset_index(drop=True), count))

    dealt = df.repartition(*keys).sortWithinPartitions(*keys, *order)
    return dealt.mapInPandas(stream, schema)


def schema_with(df: DataFrame, **more: str) -> str:
    """df's columns and further ones as a schema text."""
    return ", ".join([f"`{n}` {t}" for n, t in df.dtypes if n not in more] + [f"`{n}` {t}" for n, t in more.items()])
