"""Interval joins on bins of several sizes, and counts of intervals without pairs.

Each interval has a level, the smallest bin size that is not shorter than it, so it touches two bins
of that level at most. A pair meets at the coarser of its two levels, where one side at least is at its own:
the left one at its own with the right one at its own or a coarser (tag 1), or the right one at its
own with the left one at a coarser (tag 2). It meets there in the first bin that both touch: an
equi-join without duplicates, in which a very long interval costs as few rows as a short one and
short ones never meet in a coarse bin. A count by level goes before the join, so a row is keyed only at levels
where the other side has rows to meet. Intervals are closed; stops before starts never match.

Counts need no pairs: as many intervals overlap a place's surroundings as begin up to its end, less those that
stop before its start, and both are running sums over the places in order.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: Bin sizes as powers of two.
LEVELS = (11, 14, 17, 20, 24, 40)
#: Running sums are made in stretches of 2 to this power of places.
STRETCH = 16
#: Rows of at most so many places more than one are counted in one piece; changes so near to a stretch's beginning go to the one before, too.
REACH = 4096
#: A side of an interval join with at most so many rows is broadcast. Others never are: Spark's own estimate
#: of a keyed side leaves out that it has several rows of each.
SMALL = 20_000
#: The smaller side of an interval join, a quarter of the other at most, is held in memory by key and the other one not sorted, where
#: it has at most so many rows, and so many for each shuffle partition. Elsewhere both are sorted, which needs no memory.
HELD, HELD_IN_TASK = 12_000_000, 100_000
#: A side FEWER times smaller than the other is cut into bins 2 to the power of FINE smaller than its intervals ask for: a few more
#: copies of its rows, each in up to 9 bins, spare the many rows of the other one their copies at coarser levels.
FEWER, FINE = 4, 3


def _level(start: str, stop: str, fine: int = 0) -> Column:
    """The level of an interval, or that of one shorter by 2 to the power of fine."""
    size = F.shiftright(F.col(stop) - F.col(start), fine) + 1
    level = F.lit(LEVELS[-1])
    for p in reversed(LEVELS[:-1]):
        level = F.when(size <= (1 << p), p).otherwise(level)
    return level


def levels(*sides: tuple[DataFrame, str, str]) -> list[dict[int, int]]:
    """Of each side (rows, start, stop) its number of rows by level, from one pass over all sides."""
    return [coarse for coarse, _ in _both_levels(*sides)]


def _both_levels(*sides: tuple[DataFrame, str, str]) -> list[tuple[dict[int, int], dict[int, int]]]:
    """levels(), and the numbers of rows by the level that a side has in bins FINE powers of two smaller."""
    found: list[tuple[dict[int, int], dict[int, int]]] = [({}, {}) for _ in sides]
    table = None
    for k, (df, start, stop) in enumerate(sides):
        own = df.where(F.col(start) <= F.col(stop)).select(F.lit(k).alias("side"), _level(start, stop).alias("level"), _level(start, stop, FINE).alias("finer"))
        table = own if table is None else table.unionAll(own)
    for r in table.groupBy("side", "level", "finer").count().collect():
        for counts, level in zip(found[r["side"]], (r["level"], r["finer"])):
            counts[level] = counts.get(level, 0) + r["count"]
    return found


def left_levels(left: DataFrame, start: str, stop: str) -> tuple[dict[int, int], dict[int, int]]:
    """Sizes for overlap_join() by a pass over a small left side alone, where the right one is long to work out: the right rows
    are keyed only where left ones are, the left rows at every level from their own, and the right side counts as the larger one."""
    return levels((left, start, stop))[0], dict.fromkeys(LEVELS, math.inf)


def _held(df: DataFrame, rows: float, other: float) -> bool:
    """Whether a side of so many rows is held in memory, against an other one of so many."""
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows * 4 <= other and rows <= min(HELD, HELD_IN_TASK * tasks)


def _keyed(df: DataFrame, start: str, stop: str, side: str, own: dict[int, int], other: dict[int, int], fine: int = 0) -> DataFrame:
    """df with the bins, by level and tag in one number, in which its rows can meet rows of the other side's levels."""
    at_own, coarser = (1, 2) if side == "l" else (2, 1)
    keys = []
    for p in LEVELS:
        bins = lambda t, p=p: F.transform(F.sequence(F.shiftright(F.col(start).cast("long"), p), F.shiftright(F.col(stop).cast("long"), p)), lambda k: k * (1 << 8) + 4 * p + t)
        finer = any(q < p for q in other)
        # at its own level a row meets rows there (tag 1) and finer ones, at a coarser one the rows whose own level that is
        if p in own:
            here = F.col(f"__{side}_level") == p
            if p in other or (side == "l" and finer):
                keys.append(F.when(here, bins(1)).otherwise(F.array()))
            if side == "r" and finer:
                keys.append(F.when(here, bins(at_own)).otherwise(F.array()))
        if p in other and any(q < p for q in own):
            keys.append(F.when(F.col(f"__{side}_level") < p, bins(coarser)).otherwise(F.array()))
    keyed = df.where(F.col(start) <= F.col(stop)).withColumn(f"__{side}_level", _level(start, stop, fine))
    none = F.array().cast("array<bigint>")
    return keyed.withColumn(f"__{side}key", F.explode(F.flatten(F.array(*keys)) if keys else none)).drop(f"__{side}_level")


def _prefixed(df: DataFrame, prefix: str) -> DataFrame:
    return df.select(*[F.col(c).alias(prefix + c) for c in df.columns])


def overlap_join(left: DataFrame, right: DataFrame, residual: Column | None = None, left_on: tuple[str, str, str] = ("chrom", "start", "stop"), right_on: tuple[str, str, str] = ("chrom", "start", "stop"), prefix: str = "r_", sizes: tuple[dict[int, int], dict[int, int]] | None = None) -> DataFrame:
    """All pairs of overlapping intervals on the same chromosome; the right side's columns get prefix.
    residual: a further condition over both sides' columns; sizes: levels() of both sides, where they are known."""
    fine = [0, 0]
    if sizes:
        own, other = sizes
    else:
        both = _both_levels((left, left_on[1], left_on[2]), (right, right_on[1], right_on[2]))
        rows = [sum(coarse.values()) for coarse, _ in both]
        fine = [FINE if SMALL < n * FEWER <= m else 0 for n, m in (rows, rows[::-1])]
        own, other = [finer if f else coarse for (coarse, finer), f in zip(both, fine)]
    r = _keyed(_prefixed(right, prefix), prefix + right_on[1], prefix + right_on[2], "r", other, own, fine[1])
    a = _keyed(left, left_on[1], left_on[2], "l", own, other, fine[0])
    first = lambda p: F.greatest(F.shiftright(F.col(left_on[1]).cast("long"), p), F.shiftright(F.col(prefix + right_on[1]).cast("long"), p))
    level, at = F.shiftright("__lkey", 2).bitwiseAND(63), F.lit(None).cast("long")
    for p in LEVELS:
        at = F.when(level == p, first(p)).otherwise(at)
    meets = (
        (F.col(left_on[0]) == F.col(prefix + right_on[0])) & (F.col("__lkey") == F.col("__rkey"))
        & (F.col(left_on[1]) <= F.col(prefix + right_on[2])) & (F.col(left_on[2]) >= F.col(prefix + right_on[1])) & (F.shiftright("__lkey", 8) == at)
    )
    n_left, n_right = sum(own.values()), sum(other.values())
    if n_right <= SMALL:
        r = r.hint("broadcast")
    elif n_left <= SMALL:
        a = a.hint("broadcast")
    elif _held(left, n_left, n_right):
        a = a.hint("shuffle_hash")
    elif _held(left, n_right, n_left):
        r = r.hint("shuffle_hash")
    else:
        a = a.hint("merge")
    out = a.join(r, meets if residual is None else meets & residual)
    return out.drop("__lkey", "__rkey")


def _changes(right: DataFrame, right_on: tuple[str, str, str]) -> DataFrame:
    """By place, the intervals that begin there and those that have stopped just before it."""
    chrom, start, stop = right_on
    change = lambda at, up, down: F.struct(F.col(at).cast("long").alias("place") if up else (F.col(at).cast("long") + 1).alias("place"), F.lit(up).cast("long").alias("up"), F.lit(down).cast("long").alias("down"))
    changes = right.where(F.col(chrom).isNotNull() & (F.col(start) <= F.col(stop))).select(F.col(chrom).alias("__chrom"), F.explode(F.array(change(start, 1, 0), change(stop, 0, 1))).alias("c"))
    return changes.groupBy("__chrom", F.col("c.place").alias("__place")).agg(F.sum("c.up").alias("__up"), F.sum("c.down").alias("__down"))


def _sums_before(changes: DataFrame, parts: DataFrame) -> DataFrame:
    """Of each stretch in which a place is asked for, a row at its beginning with the sums of the changes before it."""
    part = F.shiftright("__place", STRETCH)
    edges = changes.groupBy("__chrom", part.alias("__part")).agg(F.sum("__up").alias("u"), F.sum("__down").alias("d"))
    along = Window.partitionBy("__chrom").orderBy("__part")
    upto = lambda c: F.sum(c).over(along.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    carried = edges.select("__chrom", (F.col("__part") + 1).alias("__part"), upto("u").alias("__up"), upto("d").alias("__down"))
    # the sums before each stretch in which a place is asked for: those up to the last stretch with changes before it
    steps = carried.select("__chrom", "__part", "__up", "__down", F.lit(False).alias("asked")).unionByName(parts.select("__chrom", "__part", F.lit(None).cast("long").alias("__up"), F.lit(None).cast("long").alias("__down"), F.lit(True).alias("asked")))
    last = lambda c: F.last(c, ignorenulls=True).over(Window.partitionBy("__chrom").orderBy("__part", "asked").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    before = steps.withColumns({"__up": F.coalesce(last("__up"), F.lit(0)), "__down": F.coalesce(last("__down"), F.lit(0))}).where("asked")
    return before.select("__chrom", F.shiftleft("__part", STRETCH).alias("__place"), "__up", "__down")


def _ranked(left: DataFrame, right: DataFrame, ident: list[str], name: str, asked: tuple[str, str, str], right_on: tuple[str, str, str]) -> DataFrame:
    """Per ident, the right intervals that begin up to the place asked[1] of left, less those that stop before the place asked[2].
    Places of both sides are put in order in stretches; one row of each stretch carries the sums over its edges."""
    changes, part = _changes(right, right_on), F.shiftright("__place", STRETCH)
    ask = F.array(F.struct(F.col(asked[1]).cast("long").alias("place"), F.lit(True).alias("begun")), F.struct(F.col(asked[2]).cast("long").alias("place"), F.lit(False).alias("begun")))
    asks = left.select(*ident, F.col(asked[0]).alias("__chrom"), F.explode(ask).alias("a")).select(*ident, "__chrom", F.col("a.place").alias("__place"), F.col("a.begun").alias("__begun"))
    parts = asks.where(F.col("__chrom").isNotNull()).select("__chrom", part.alias("__part")).distinct()
    first = _sums_before(changes, parts).withColumn("__begun", F.lit(None).cast("boolean"))
    rows = changes.withColumn("__begun", F.lit(None).cast("boolean")).unionByName(first).unionByName(asks.where(F.col("__chrom").isNotNull()), allowMissingColumns=True)
    within = Window.partitionBy("__chrom", "__part").orderBy("__place").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    total = F.when(F.col("__begun"), F.sum("__up").over(within)).otherwise(-F.sum("__down").over(within))
    summed = rows.withColumn("__part", part).withColumn("__n", F.coalesce(total, F.lit(0))).where(F.col("__begun").isNotNull())
    return summed.groupBy(*ident).agg(F.sum("__n").alias(name))


def _ranked_near(left: DataFrame, right: DataFrame, ident: list[str], name: str, asked: tuple[str, str, str], low: str, right_on: tuple[str, str, str]) -> DataFrame:
    """left with the same number, for rows whose places lie within REACH of low, the smaller one; 0 of those without places or chromosome.
    A row moves once, to the stretch of low, and is put in order there by one place and then by the other."""
    changes = _changes(right, right_on)
    here = F.shiftright("__place", STRETCH)
    near_edge = F.col("__place").bitwiseAND((1 << STRETCH) - 1) <= REACH
    marks = changes.withColumn("__part", F.explode(F.when(near_edge, F.array(here, here - 1)).otherwise(F.array(here))))
    known = F.col(asked[0]).isNotNull() & F.coalesce(F.col(asked[1]) <= F.col(asked[2]) if low == asked[1] else F.col(asked[2]) <= F.col(asked[1]), F.lit(False))
    # rows without places are dealt by their identifier
    rows = left.withColumns({"__chrom": F.when(known, F.col(asked[0])), "__part": F.when(known, F.shiftright(F.col(low).cast("long"), STRETCH)).otherwise(F.xxhash64(*ident)), "__begun": F.col(asked[1]).cast("long"), "__ended": F.col(asked[2]).cast("long"), "__own": known})
    parts = rows.where("__own").select("__chrom", "__part").distinct()
    first = _sums_before(changes, parts).withColumn("__part", here)
    marks = marks.unionByName(first).withColumns({"__begun": F.col("__place"), "__ended": F.col("__place")}).drop("__place")
    both = rows.unionByName(marks, allowMissingColumns=True)
    upto = lambda at: Window.partitionBy("__chrom", "__part").orderBy(at).rangeBetween(Window.unboundedPreceding, Window.currentRow)
    summed = both.withColumn("__n", F.sum("__up").over(upto("__begun"))).withColumn("__m", F.sum("__down").over(upto("__ended")))
    n = F.when(F.col("__own"), F.coalesce("__n", F.lit(0)) - F.coalesce("__m", F.lit(0))).otherwise(0)
    return summed.where(F.col("__own").isNotNull()).select(*left.columns, n.cast("long").alias(name))


def _ranked_all(left: DataFrame, right: DataFrame, ident: list[str], name: str, left_on: tuple[str, str, str], right_on: tuple[str, str, str], covering: bool) -> DataFrame:
    """left with the right intervals that begin up to its end, less those that stop before its start (covering: the reverse)."""
    chrom, low, high = left_on
    asked = (chrom, low, high) if covering else (chrom, high, low)
    size = F.col(high).cast("long") - F.col(low).cast("long")
    far = left.where(size > REACH)
    if far.isEmpty():
        return _ranked_near(left, right, ident, name, asked, low, right_on)
    own = far.select(*dict.fromkeys([*ident, *left_on]))
    hits = far.join(_ranked(own, right, ident, name, asked, right_on), ident, "left").withColumn(name, F.coalesce(name, F.lit(0)))
    near = left.where(F.coalesce(size <= REACH, F.lit(True)))
    return _ranked_near(near, right, ident, name, asked, low, right_on).unionByName(hits.select(*left.columns, name))


def count_overlaps(left: DataFrame, right: DataFrame, ident: list[str], name: str = "n", residual: Column | None = None, left_on: tuple[str, str, str] = ("chrom", "start", "stop"), right_on: tuple[str, str, str] = ("chrom", "start", "stop")) -> DataFrame:
    """left with the number of right intervals that overlap each row; ident names a row of left.
    With a residual pairs are made, and counted in the tasks that make them before anything moves."""
    if residual is None:
        return _ranked_all(left, right, ident, name, left_on, right_on, False)
    own = left.select(*dict.fromkeys([*ident, *left_on])).where(F.col(left_on[1]) <= F.col(left_on[2]))
    hits = overlap_join(own, right.select(*dict.fromkeys(right_on)), residual, left_on, right_on).groupBy(*ident).agg(F.count(F.lit(1)).alias(name))
    return left.join(hits, ident, "left").withColumn(name, F.coalesce(name, F.lit(0)))


def count_covering(left: DataFrame, right: DataFrame, ident: list[str], name: str = "n", left_on: tuple[str, str, str] = ("chrom", "start", "stop"), right_on: tuple[str, str, str] = ("chrom", "start", "stop")) -> DataFrame:
    """The same for right intervals that contain the left one: those that begin up to its start, less those that stop before
    its end, which takes off intervals inside it that never began before it. Only where right has intervals as
    short as that are these found, by pairs, and added."""
    chrom, low, high = left_on
    counted = _ranked_all(left, right, ident, name, left_on, right_on, True)
    own = left.select(*dict.fromkeys([*ident, *left_on])).where(F.col(low) <= F.col(high))
    longest = own.agg(F.max(F.col(high) - F.col(low))).head()[0]
    size = F.col(right_on[2]) - F.col(right_on[1])
    short = right.where((size >= 0) & (size < (-1 if longest is None else longest)))
    if short.isEmpty():
        return counted
    inside = (F.col("r_" + right_on[1]) > F.col(low)) & (F.col("r_" + right_on[2]) < F.col(high))
    nested = overlap_join(own, short.select(*dict.fromkeys(right_on)), inside, left_on, right_on).groupBy(*ident).agg(F.count(F.lit(1)).alias("__more"))
    return counted.join(nested, ident, "left").withColumn(name, F.col(name) + F.coalesce("__more", F.lit(0))).drop("__more")


def insertions_in_duplications(candidates: DataFrame, least_ratio: float = 0.8, ident: str = "svid") -> DataFrame:
    """candidates without the insertions that a duplication of the same chromosome explains, by identifier:
    the insertion starts within 500 of the duplication, the duplication starts before the insertion's
    start less 50, which lies before its stop, and the sizes' ratio is least_ratio at least."""
    ins = candidates.where("sv_type = 'INS'").select(ident, "chrom", F.col("start").alias("at"), F.col("sv_len").alias("ins_len"))
    dup = candidates.where("sv_type = 'DUP'").select("chrom", F.col("start").alias("dup_start"), F.col("stop").alias("dup_stop"), F.col("sv_len").alias("dup_len"), (F.col("start") - 499).alias("low"), (F.col("stop") + 499).alias("high"))
    explained = (
        (F.col("r_dup_start") < F.col("at") - 50) & (F.col("at") - 50 < F.col("r_dup_stop"))
        & (F.least(F.try_divide("ins_len", "r_dup_len"), F.try_divide("r_dup_len", "ins_len")) >= least_ratio)
    )
    drop = overlap_join(ins, dup, explained, ("chrom", "at", "at"), ("chrom", "low", "high")).select(ident).distinct()
    return candidates.join(drop, ident, "left_anti")


def nearest_breakpoints(points: DataFrame, breakpoints: DataFrame, ident: list[str], reach: int = 100) -> DataFrame:
    """points (chrom, pos) with the number of breakpoints within reach, both ends included."""
    near = points.withColumns({"__low": F.col("pos") - reach, "__high": F.col("pos") + reach})
    ends = breakpoints.select("chrom", F.col("pos").alias("at"))
    return count_overlaps(near, ends, ident, "break_n", None, ("chrom", "__low", "__high"), ("chrom", "at", "at")).drop("__low", "__high")
