"""Phrase collocation mining: Apriori by length, counted in the slots of minimal perfect hashes.

Texts (A-Z lower-cased) are cut into pieces and those into words; everything is per language. Words that
occur LEAST times become numbers, and texts rows of numbers, -1 at other words and at the ends of pieces.
A phrase of k words is the pair of its first and its last k - 1 words, each the slot of a phrase one shorter,
so its 64-bit key is exact. Only numbers that stand side by side are kept for the next length. Only places where both parts are frequent are looked at (Apriori): tasks send
the keys that they meet, those met LEAST times in all are the candidates, and a minimal perfect hash is
built of each part of PART candidates. Mappers look all places up, keys stored by slot sorting out what is
no candidate, count slots with numpy's bincount and write the slots down for the next length; the counts are
summed in a tree. A phrase's cuts are read from the slots of its parts: the counts of the first words are those
of its first part and of that one's first words, the counts of the last words likewise.

Words go to workers in parts of WORDS, hashes in groups of GROUP parts; more of them are more passes. A text
is never cut, so a worker holds the numbers of its longest text. A length has 2**31 frequent phrases at most.

Defined results: a null text is empty, a null language is "und"; repeated rows count each; a phrase's count holds
overlapping places; no frequent words give no rows.
"""

from __future__ import annotations

import math
import pickle
from array import array
from collections import Counter, defaultdict
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import SparkFiles, TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from strandmill.llm.perfect_hash import PerfectHash
from strandmill.llm.shared import cut, fresh_path, ship_bytes, tidy

LEAST, LONGEST, TOP, SHARE = 100, 5, 2000, 100
PART, GROUP, WORDS = 1 << 16, 64, 1_000_000
#: A task sends counts of words when it holds so many; numbers in a written row.
HELD, ROW = 100_000, 1 << 16
#: Keys that a task holds before it sends them; numbers of the texts to a part of the keys that tasks send; numbers worked on at once.
MET, SHARE_OF_KEYS, TOGETHER = 1_000_000, 1 << 21, 1 << 19
#: What ends a piece becomes a line feed, a tab a space; A-Z are lower-cased.
PIECES = bytes(10 if b in b".,;:!?\n\x0b\x0c\r" else 32 if b == 9 else b + 32 if 65 <= b <= 90 else b for b in range(256))
PLAIN = bytes(32 if b == 10 else b for b in PIECES)


def rows_of(docs: DataFrame, text_col: str, lang_col: str) -> DataFrame:
    return docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"), F.col(text_col).cast("binary").alias("text")).where("text is not null")


def word_counts(rows: DataFrame, least: int) -> DataFrame:
    """lang, word (binary), n of words with n of least or more, and of each language's words together (word null)."""

    def batch(counts: dict[str, Counter]) -> pa.RecordBatch:
        langs, words, n = [], [], []
        for lang, own in counts.items():
            langs += [lang] * (len(own) + 1)
            words += [None, *own]
            n += [own.total(), *own.values()]
        return pa.RecordBatch.from_arrays([pa.array(langs, pa.string()), pa.array(words, pa.binary()), pa.array(n, pa.int64())], names=["lang", "word", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, Counter] = defaultdict(Counter)
        for part in batches:
            for lang, text in zip(part.column(0).to_pylist(), part.column(1)):
                flat, low, own = text.as_py().translate(PLAIN), 0, counts[lang]
                while low < len(flat):  # a long text is never one list of words
                    high = flat.find(b" ", low + (1 << 20))
                    high = len(flat) if high < 0 else high
                    own.update(flat[low:high].split())
                    low = high
                if sum(map(len, counts.values())) > HELD:
                    yield batch(counts)
                    counts = defaultdict(Counter)
        yield batch(counts)

    found = rows.mapInArrow(tidy(run), "lang string, word binary, n long")
    return found.groupBy("lang", "word").agg(F.sum("n").alias("n")).where(F.col("word").isNull() | (F.col("n") >= least))


def numbered(words: DataFrame) -> tuple[DataFrame, int]:
    """words with part and number, from 0, dense; and how many parts there are."""
    total = words.count()
    parts = max(1, math.ceil(total / WORDS))
    placed = words.withColumn("part", F.pmod(F.xxhash64("lang", "word"), F.lit(parts)).cast("int"))
    sizes = {r["part"]: r["count"] for r in placed.groupBy("part").count().collect()}
    base = dict(zip(range(parts), np.append(0, np.cumsum([sizes.get(k, 0) for k in range(parts)])).tolist()))
    start = F.element_at(F.array(*[F.lit(base[k]) for k in range(parts)]), F.col("part") + 1)
    return cut(placed.withColumn("number", F.row_number().over(Window.partitionBy("part").orderBy("lang", "word")) - 1 + start)), parts


def encode(rows: DataFrame, words: DataFrame, parts: int) -> DataFrame:
    """own (packed int32): the numbers of all texts' words, -1 at others and after each piece."""
    spark, folder = rows.sparkSession, fresh_path(rows.sparkSession, "numbers")
    for part in range(parts):
        table: dict[str, dict[bytes, int]] = defaultdict(dict)
        for lang, word, number in words.where(F.col("part") == part).select("lang", "word", "number").toLocalIterator():
            table[lang][bytes(word)] = number
        name = ship_bytes(spark, "words", pickle.dumps(dict(table)))
        encode_part(rows, name, part == parts - 1).write.parquet(f"{folder}/{part}")
        rows = spark.read.parquet(f"{folder}/{part}")
    return rows


def encode_part(rows: DataFrame, name: str, last: bool) -> DataFrame:
    """Numbers of the shipped words filled in; the last part leaves the numbers alone, many texts a row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with open(SparkFiles.get(name), "rb") as file:
            table = pickle.load(file)
        packed, size = [], 0
        for batch in batches:
            before = batch.column(2).to_pylist() if batch.num_columns > 2 else repeat(None)
            texts, own = [], []
            for lang, text, known in zip(batch.column(0).to_pylist(), batch.column(1), before):
                get, numbers = table.get(lang, {}).get, array("i")
                for piece in text.as_py().translate(PIECES).split(b"\n"):
                    if found := piece.split():
                        numbers.extend(map(get, found, repeat(-1)))
                        numbers.append(-1)
                flat = np.frombuffer(numbers, np.int32) if len(numbers) else np.array([], np.int32)
                flat = flat if known is None else np.maximum(flat, np.frombuffer(known, np.int32))
                if last:
                    flat = neighbours(flat)
                    packed.append(flat.tobytes())
                    size += len(flat)
                    if size >= ROW:
                        yield pa.RecordBatch.from_arrays([pa.array([b"".join(packed)], pa.binary())], names=["own"])
                        packed, size = [], 0
                else:
                    own.append(flat.tobytes())
            if not last:
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(own, pa.binary())], names=["lang", "text", "own"])
        if size:
            yield pa.RecordBatch.from_arrays([pa.array([b"".join(packed)], pa.binary())], names=["own"])

    return rows.mapInArrow(tidy(run), "own binary" if last else "lang string, text binary, own binary")


def neighbours(numbers: np.ndarray) -> np.ndarray:
    """The numbers that stand beside another one, with a single -1 after each run: all that longer phrases need."""
    real = np.concatenate([[False], numbers >= 0, [False]])
    near = real[1:-1] & (real[:-2] | real[2:])
    keep = near | np.append(False, near[:-1])
    out = np.where(near, numbers, -1)[keep].astype(np.int32)
    return np.append(out, np.int32(-1)) if len(out) and out[-1] >= 0 else out


def gathered(batches: Iterator[pa.RecordBatch], columns: int) -> Iterator[list[np.ndarray]]:
    """The packed columns of the rows, about TOGETHER numbers at once; every row ends in -1."""
    held: list[list[bytes]] = [[] for _ in range(columns)]
    size = 0
    for batch in batches:
        for k in range(batch.num_rows):
            for own, column in zip(held, batch.columns):
                own.append(column[k].as_py())
            size += len(held[0][-1]) // 4
            if size >= TOGETHER:
                yield [np.frombuffer(b"".join(own), np.int32) for own in held]
                held, size = [[] for _ in range(columns)], 0
    if size:
        yield [np.frombuffer(b"".join(own), np.int32) for own in held]


def pairs_of(before: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places where a phrase and the next one are frequent, and the keys of the two."""
    at = np.flatnonzero((before[:-1] >= 0) & (before[1:] >= 0))
    return at, (before[at].astype(np.uint64) << np.uint64(32)) | before[at + 1].astype(np.uint64)


def part_of(keys: np.ndarray, parts: int) -> np.ndarray:
    return (((keys >> np.uint64(32)) * np.uint64(31) + (keys & np.uint64(0xFFFFFFFF))) % np.uint64(parts)).astype(np.int64)


def candidates(numbers: DataFrame, least: int, parts: int) -> DataFrame:
    """key of the phrases whose parts are frequent and that occur least times. Tasks send the keys that they met and their
    counts packed, in parts by key; a part adds up what the tasks met."""

    def packed(keys: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
        place = part_of(keys, parts)
        order = np.argsort(place, kind="stable")
        cuts = np.searchsorted(place[order], np.arange(parts + 1))
        some = [k for k in range(parts) if cuts[k] < cuts[k + 1]]
        take = [order[cuts[k] : cuts[k + 1]] for k in some]
        return pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array([keys[t].tobytes() for t in take], pa.binary()), pa.array([counts[t].tobytes() for t in take], pa.binary())], names=["part", "keys", "counts"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, counts = np.array([], np.uint64), np.array([], np.int64)
        for (own,) in gathered(batches, 1):
            keys, n = np.unique(pairs_of(own)[1], return_counts=True)
            held, counts = added([held, keys], [counts, n])
            if len(held) > MET:
                yield packed(held, counts)
                held, counts = held[:0], counts[:0]
        yield packed(held, counts)

    def add(group: pd.DataFrame) -> pd.DataFrame:
        keys, n = added([np.frombuffer(k, np.uint64) for k in group["keys"]], [np.frombuffer(c, np.int64) for c in group["counts"]])
        return pd.DataFrame({"key": keys[n >= least].view(np.int64)})

    return numbers.select("own").mapInArrow(tidy(run), "part int, keys binary, counts binary").groupBy("part").applyInPandas(add, "key long")


def added(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """The distinct keys and their counts' sums."""
    distinct, back = np.unique(np.concatenate(keys), return_inverse=True)
    return distinct, np.bincount(back, np.concatenate(counts), len(distinct)).astype(np.int64)


def hashes(keys: DataFrame) -> tuple[DataFrame, list[int]]:
    """part, hash: a perfect hash of each part of the keys; and the first slot of each part."""
    parts = max(1, math.ceil(keys.count() / PART))
    part = (F.shiftrightunsigned("key", 32) * 31 + F.col("key").bitwiseAND(0xFFFFFFFF)) % parts
    build = lambda g: pd.DataFrame({"part": [g["part"].iloc[0]], "size": [len(g)], "hash": [PerfectHash.build(np.sort(g["key"].to_numpy(np.int64).view(np.uint64))).to_bytes()]})
    built = cut(keys.withColumn("part", part.cast("int")).groupBy("part").applyInPandas(build, "part int, size long, hash binary"))
    sizes = {r["part"]: r["size"] for r in built.select("part", "size").collect()}
    return built, np.append(0, np.cumsum([sizes.get(k, 0) for k in range(parts)])).tolist()


def count_slots(numbers: DataFrame, built: DataFrame, starts: list[int]) -> tuple[DataFrame, DataFrame]:
    """The next length's slots of all places, and the written count rows: part, task, slots, counts (packed)."""
    spark, folder = numbers.sparkSession, fresh_path(numbers.sparkSession, "slots")
    parts = len(starts) - 1
    tables = []
    groups = range(0, parts, GROUP)
    for low in groups:
        some = {r["part"]: bytes(r["hash"]) for r in built.where(F.col("part").between(low, low + GROUP - 1)).select("part", "hash").toLocalIterator()}
        name = ship_bytes(spark, "hashes", pickle.dumps(some))
        _slots_pass(numbers, name, starts, low == groups[-1]).write.parquet(f"{folder}/{low}")
        table = spark.read.parquet(f"{folder}/{low}")
        tables.append(table.where("counts is not null").select("part", "task", "slots", "counts"))
        numbers = table.where("counts is null").select("own", *(["next"] if low != groups[-1] else []))
    counts = tables[0]
    for t in tables[1:]:
        counts = counts.unionByName(t)
    return numbers, counts


def _slots_pass(numbers: DataFrame, name: str, starts: list[int], last: bool) -> DataFrame:
    """One group of hashes. Slots that earlier groups found stand in next, place by place; the last group leaves the slots alone."""
    parts, filled = len(starts) - 1, "next" in numbers.columns
    names = ["own", "next", "part", "task", "slots", "counts"]
    kinds = [pa.binary(), pa.binary(), pa.int32(), pa.int32(), pa.binary(), pa.binary()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with open(SparkFiles.get(name), "rb") as file:
            own = {k: PerfectHash.from_bytes(v) for k, v in pickle.load(file).items()}
        counts = {k: np.zeros(len(h.keys), np.int64) for k, h in own.items()}
        for before, *known in gathered(batches, 2 if filled else 1):
            slots = known[0].copy() if known else np.full(len(before), -1, np.int32)
            at, keys = pairs_of(before)
            place = part_of(keys, parts)
            for part, hash_ in own.items():
                mine = np.flatnonzero(place == part) if parts > 1 else np.arange(len(keys))
                slot = hash_.find(keys[mine])
                hit = slot >= 0
                counts[part] += np.bincount(slot[hit], minlength=len(hash_.keys))
                slots[at[mine[hit]]] = starts[part] + slot[hit]
            left = neighbours(slots) if last else before
            if len(left):
                row = [left.tobytes(), None if last else slots.tobytes(), None, None, None, None]
                yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, kinds)], names=names)
        for part, n in counts.items():
            some = np.flatnonzero(n)
            row = [None, None, part, TaskContext.get().partitionId(), some.astype(np.uint32).tobytes(), n[some].tobytes()]
            yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, kinds)], names=names)

    return numbers.mapInArrow(tidy(run), "own binary, next binary, part int, task int, slots binary, counts binary")


def summed(counts: DataFrame, built: DataFrame, starts: list[int]) -> DataFrame:
    """slot, first, last, n: the tasks' counts added in a tree, next to the key stored at each slot."""
    branch = max(1, round(math.sqrt(counts.select("task").distinct().count())))

    def add(group: pd.DataFrame) -> pd.DataFrame:
        slots = [np.frombuffer(s, np.uint32) for s in group["slots"]]
        own = np.zeros(1 + max(int(s.max(initial=0)) for s in slots), np.int64)
        for s, n in zip(slots, group["counts"]):
            own[s] += np.frombuffer(n, np.int64)
        some = np.flatnonzero(own)
        return pd.DataFrame({"part": [group["part"].iloc[0]], "slots": [some.astype(np.uint32).tobytes()], "counts": [own[some].tobytes()]})

    def told(key: tuple, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        keys = PerfectHash.from_bytes(right["hash"].iloc[0]).keys
        n = np.zeros(len(keys), np.int64)
        for s, c in zip(left["slots"], left["counts"]):
            n[np.frombuffer(s, np.uint32)] += np.frombuffer(c, np.int64)
        return pd.DataFrame({"slot": starts[key[0]] + np.arange(len(keys)), "first": (keys >> np.uint64(32)).astype(np.int64), "last": (keys & np.uint64(0xFFFFFFFF)).astype(np.int64), "n": n})

    half = counts.withColumn("branch", F.col("task") % branch).groupBy("part", "branch").applyInPandas(add, "part int, slots binary, counts binary")
    return cut(half.groupBy("part").cogroup(built.groupBy("part")).applyInPandas(told, "slot long, first long, last long, n long"))


def phrases(rows: DataFrame, least: int = LEAST, longest: int = LONGEST) -> tuple[list[DataFrame], DataFrame]:
    """Of each length from 1: slot, lang, words (binary), n, starts (counts of the first 1, 2, ... words), ends (of the
    last 1, 2, ...), within (the largest count of a phrase one longer that holds it); and lang, total."""
    counted = cut(word_counts(rows, least))
    totals = counted.where("word is null").select("lang", F.col("n").alias("total"))
    words, parts = numbered(counted.where("word is not null"))
    none = F.array().cast("array<long>")
    levels = [words.select(F.col("number").cast("long").alias("slot"), "lang", F.array("word").alias("words"), "n", none.alias("starts"), none.alias("ends"))]
    numbers = encode(rows, words, parts) if words.count() else None
    met = max(1, math.ceil((numbers.agg(F.sum(F.length("own"))).head()[0] or 0) / 4 / SHARE_OF_KEYS)) if numbers is not None else 1
    while numbers is not None and len(levels) < longest:
        keys = cut(candidates(numbers, least, met))
        if not keys.count():
            break
        built, starts = hashes(keys)
        numbers, counts = count_slots(numbers, built, starts)
        own = summed(counts, built, starts)
        a, b = (levels[-1].select(*[F.col(c).alias(f"{c}_{x}") for c in levels[-1].columns]) for x in "ab")
        both = own.join(a, F.col("first") == F.col("slot_a")).join(b, F.col("last") == F.col("slot_b"))
        held = own.select(F.explode(F.array("first", "last")).alias("slot"), "n").groupBy("slot").agg(F.max("n").alias("within"))
        levels[-1] = levels[-1].join(held, "slot", "left")
        levels.append(cut(both.select("slot", F.col("lang_a").alias("lang"), F.concat("words_a", F.slice("words_b", -1, 1)).alias("words"), "n", F.concat("starts_a", F.array("n_a")).alias("starts"), F.concat("ends_b", F.array("n_b")).alias("ends"))))
    levels[-1] = levels[-1].withColumn("within", F.lit(None).cast("long"))
    return levels, totals


def mine(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", least: int = LEAST, longest: int = LONGEST, share: int = SHARE, top: int = TOP) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: each language's top phrases of 2 to longest words."""
    levels, totals = phrases(rows_of(docs, text_col, lang_col), least, longest)
    found = docs.sparkSession.createDataFrame([], "lang string, words array<binary>, a long, starts array<long>, ends array<long>, within long")
    for level in levels[1:]:
        found = found.unionByName(level.select("lang", "words", F.col("n").alias("a"), "starts", "ends", "within"))
    kept = found.where(F.col("within").isNull() | (100 * F.col("within") < share * F.col("a"))).join(F.broadcast(totals) if totals.count() <= 100_000 else totals, "lang")
    # decimals are exact: a count has 19 digits at most, and "div" rounds down
    best = F.expr("""array_min(transform(sequence(1, size(words) - 1), k -> named_struct(
        'score', cast(cast(a as decimal(19, 0)) * cast(total as decimal(19, 0)) * cast(1000 as decimal(4, 0)) as decimal(38, 0))
            div cast(cast(starts[k - 1] as decimal(19, 0)) * cast(ends[size(words) - k - 1] as decimal(19, 0)) as decimal(38, 0)),
        'k', k, 'l', starts[k - 1], 'r', ends[size(words) - k - 1])))""")
    scored = kept.select("lang", F.array_join(F.transform("words", lambda w: w.cast("string")), " ").alias("phrase"), "a", best.alias("cut"), F.col("total").alias("n"))
    order = Window.partitionBy("lang").orderBy(F.desc("cut.score"), F.desc("a"), "phrase")
    ranked = scored.withColumn("rank", F.row_number().over(order).cast("long")).where(F.col("rank") <= top)
    return ranked.select("lang", "rank", "phrase", "a", F.col("cut.l").alias("l"), F.col("cut.r").alias("r"), "n", F.col("cut.score").alias("score"))
