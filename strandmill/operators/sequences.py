"""Sequences in chunks: rows (chrom, chunk, text) of CHUNK letters each, the last one shorter.

A chromosome is as many rows as it fills, so no task holds one whole. A slice is an equi-join on the
chunks that it touches; inverted sequences are made piece by piece, each letter's place following from the
inversions alone, and chunks that no inversion touches are passed through unread.

Defined results: places count from 0, stops are exclusive; a slice beyond a sequence's end holds what there is,
null if there is nothing or the chromosome is unknown; an empty slice is ""; null places give null.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from strandmill.functions.scalars import reverse_complement

#: Letters of a chunk: a multiple of a FASTA line's 60.
CHUNK = 60 * 1024


def chunked(sequences: DataFrame, size: int = CHUNK) -> DataFrame:
    """Chunks of whole sequences (chrom, seq); empty and null ones have none."""
    places = F.sequence(F.lit(0), F.floor((F.length("seq") - 1) / size).cast("int"))
    return sequences.where(F.length("seq") > 0).select("chrom", "seq", F.explode(places).alias("chunk")).select("chrom", F.col("chunk").cast("long").alias("chunk"), F.expr(f"substring(seq, chunk * {size} + 1, {size})").alias("text"))


def sizes(store: DataFrame, size: int = CHUNK) -> DataFrame:
    """chrom and its length."""
    return store.groupBy("chrom").agg(F.max(F.col("chunk") * size + F.length("text")).alias("size"))


def _joined(pieces: str) -> Column:
    """The texts of collected (place, text) pieces in order."""
    return F.array_join(F.transform(F.array_sort(pieces), lambda p: p["text"]), "")


def _prefixed(store: DataFrame) -> DataFrame:
    return store.select(F.col("chrom").alias("__of"), F.col("chunk").alias("__in"), F.col("text").alias("__text"))


def slices(store: DataFrame, requests: DataFrame, ident: list[str], size: int = CHUNK, turned: str | None = None, name: str = "text") -> DataFrame:
    """requests (ident, chrom, start, stop) with the letters from start to stop as name; turned: a column that tells
    whether they are reverse-complemented. ident names a request. A request within one chunk moves once."""
    low, high = F.greatest("start", F.lit(0)), F.col("stop")
    within = F.expr("substring(__text, cast(greatest(start, __in * {s}) - __in * {s} + 1 as int), cast(least(stop, (__in + 1) * {s}) - greatest(start, __in * {s}) as int))".format(s=size))
    asked = requests.withColumns({"__first": F.floor(low / size), "__last": F.floor((high - 1) / size)})
    known = F.col("start").isNotNull() & F.col("stop").isNotNull()
    single, many = asked.where(known & (F.col("__last") <= F.col("__first"))), asked.where(known & (F.col("__last") > F.col("__first")))
    chunks = _prefixed(store)
    meets = (F.col("chrom") == F.col("__of")) & (F.col("__first") == F.col("__in"))
    found = F.when(F.col("stop") <= low, F.lit("")).otherwise(F.nullif(within, F.lit("")))
    one = single.join(chunks, meets, "left").withColumn("__found", found)
    spread = many.select(*dict.fromkeys([*ident, "chrom", "start", "stop", "__first", "__last"])).distinct().withColumn("__first", F.explode(F.sequence("__first", "__last"))).join(chunks, meets)
    whole = spread.select(*ident, F.struct(F.col("__in").alias("place"), within.alias("text")).alias("__p")).groupBy(*ident).agg(F.collect_list("__p").alias("__p"))
    more = many.join(whole, ident, "left").withColumn("__found", F.nullif(_joined("__p"), F.lit("")))
    none = asked.where(~known).withColumn("__found", F.lit(None).cast("string"))
    columns = [*requests.columns, "__found"]
    out = one.select(*columns).unionByName(more.select(*columns)).unionByName(none.select(*columns))
    text = F.col("__found") if turned is None else F.when(F.col(turned), reverse_complement(F.col("__found"))).otherwise(F.col("__found"))
    return out.withColumn(name, text).drop("__found")


def rearranged(start: int, stop: int, inversions: list[tuple[int, int]]) -> list[tuple[int, int, bool]]:
    """The source pieces (start, stop, turned) of the region, in order, after the inversions in their order."""
    pieces = [(start, stop, False)]
    for a, b in inversions:
        at, before, inside, after = start, [], [], []
        for s, e, t in pieces:
            n = e - s
            cuts = sorted({0, n, min(max(a - at, 0), n), min(max(b - at, 0), n)})
            for x, y in zip(cuts, cuts[1:]):
                part = (e - y, e - x, t) if t else (s + x, s + y, t)
                (before if at + y <= a else after if at + x >= b else inside).append(part)
            at += n
        pieces = before + [(s, e, not t) for s, e, t in reversed(inside)] + after
    return pieces


def _chains(inversions: DataFrame, lengths: DataFrame) -> DataFrame:
    """Inversions, cut off at the sequence's end, with the chain of overlapping ones they are in."""
    own = inversions.select("chrom", "start", "stop").distinct().join(lengths, "chrom")
    own = own.select("chrom", F.greatest("start", F.lit(0)).cast("long").alias("start"), F.least("stop", "size").cast("long").alias("stop"), "size", F.struct("start", "stop").alias("as")).where("start < stop")
    before = Window.partitionBy("chrom").orderBy("start", "stop", "as").rowsBetween(Window.unboundedPreceding, -1)
    marked = own.withColumn("new", F.coalesce(F.col("start") >= F.max("stop").over(before), F.lit(True)).cast("int"))
    return marked.withColumn("chain", F.sum("new").over(Window.partitionBy("chrom").orderBy("start", "stop", "as").rowsBetween(Window.unboundedPreceding, 0))).drop("new")


def inverted(store: DataFrame, inversions: DataFrame, size: int = CHUNK) -> DataFrame:
    """The store with each [start, stop) slice replaced by its reverse complement, from the last to the first by start and
    stop, each on what the ones before it left. Only overlapping inversions need each other, so they are
    worked out chain by chain."""
    chained = _chains(inversions, sizes(store, size))

    def pieces_of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for chrom, starts, stops in zip(batch["chrom"], batch["starts"], batch["stops"]):
                at = int(min(starts))
                for s, e, turned in rearranged(at, int(max(stops)), list(zip(map(int, starts), map(int, stops)))):
                    rows.append((chrom, at, s, e - s, turned))
                    at += e - s
            yield pd.DataFrame(rows, columns=["chrom", "dst", "src", "n", "turned"])

    # a row is a chain with its inversions from the last to the first: a batch of them costs one call
    listed = chained.groupBy("chrom", "chain").agg(F.reverse(F.array_sort(F.collect_list(F.struct("as", "start", "stop")))).alias("i"))
    listed = listed.select("chrom", F.col("i.start").alias("starts"), F.col("i.stop").alias("stops"))
    moved = listed.mapInPandas(pieces_of, "chrom string, dst long, src long, n long, turned boolean")
    # what lies between chains stays where it is; only the chunks that it shares with a chain need its pieces
    spans = chained.groupBy("chrom", "chain").agg(F.min("start").alias("a"), F.max("stop").alias("b"), F.max("size").alias("size"))
    by = Window.partitionBy("chrom").orderBy("a")
    ahead = spans.select("chrom", F.coalesce(F.lag("b").over(by), F.lit(0)).alias("a"), F.col("a").alias("b"))
    behind = spans.withColumn("last", F.lead("a").over(by).isNull()).where("last").select("chrom", F.col("b").alias("a"), F.col("size").alias("b"))
    up, down = F.ceil(F.col("a") / size) * size, F.floor(F.col("b") / size) * size
    ends = F.when(up > down, F.array(F.struct(F.col("a").alias("a"), F.col("b").alias("b")))).otherwise(F.array(F.struct(F.col("a").alias("a"), up.alias("b")), F.struct(down.alias("a"), F.col("b").alias("b"))))
    tail = F.array(F.struct(F.col("a").alias("a"), F.least(up, F.col("b")).alias("b")))  # the last chunk is whole where the sequence ends
    pieces = ahead.select("chrom", F.explode(ends).alias("e")).unionByName(behind.select("chrom", F.explode(tail).alias("e")))
    still = pieces.where("e.a < e.b").select("chrom", F.col("e.a").alias("dst"), F.col("e.a").alias("src"), (F.col("e.b") - F.col("e.a")).alias("n"), F.lit(False).alias("turned"))
    touched = spans.select("chrom", F.explode(F.sequence(F.floor(F.col("a") / size), F.floor((F.col("b") - 1) / size))).alias("chunk")).distinct()
    cut = moved.unionByName(still)
    # by the chunk that a piece goes to, then by the chunk that it comes from
    cut = cut.withColumn("to", F.explode(F.sequence(F.floor(F.col("dst") / size), F.floor((F.col("dst") + F.col("n") - 1) / size))))
    first, last = F.greatest("dst", F.col("to") * size), F.least(F.col("dst") + F.col("n"), (F.col("to") + 1) * size)
    source = F.when(F.col("turned"), F.col("src") + F.col("n") - (last - F.col("dst"))).otherwise(F.col("src") + first - F.col("dst"))
    cut = cut.select("chrom", "to", "turned", first.alias("dst"), source.alias("src"), (last - first).alias("n"))
    cut = cut.withColumn("from", F.explode(F.sequence(F.floor(F.col("src") / size), F.floor((F.col("src") + F.col("n") - 1) / size))))
    first, last = F.greatest("src", F.col("from") * size), F.least(F.col("src") + F.col("n"), (F.col("from") + 1) * size)
    place = F.when(F.col("turned"), F.col("dst") + F.col("src") + F.col("n") - last).otherwise(F.col("dst") + first - F.col("src"))
    cut = cut.select("chrom", "to", "turned", "from", place.alias("place"), (first - F.col("from") * size + 1).cast("int").alias("at"), (last - first).cast("int").alias("n"))
    read = cut.join(_prefixed(store), (F.col("chrom") == F.col("__of")) & (F.col("from") == F.col("__in")))
    text = F.expr("substring(__text, at, n)")
    read = read.select("chrom", F.col("to").alias("chunk"), F.struct("place", F.when(F.col("turned"), reverse_complement(text)).otherwise(text).alias("text")).alias("p"))
    made = read.groupBy("chrom", "chunk").agg(F.collect_list("p").alias("p")).select("chrom", "chunk", _joined("p").alias("text"))
    return store.join(touched, ["chrom", "chunk"], "left_anti").select("chrom", "chunk", "text").unionByName(made)
