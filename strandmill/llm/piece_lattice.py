"""SentencePiece encoding and decoding by a relational lattice over the corpus's words.

A text becomes a mark (U+2581) and itself with spaces as marks, cut into units that no piece crosses:
marks with the letters after them, marks with other characters after them, marks, single digits, line
ends. That cut is right for vocabularies none of whose pieces has such a boundary inside, which is
checked; others are cut before marks only.

dictionary(): the corpus's frequent units are exploded into substrings of bounded length, equi-joined to
the piece table (broadcast; its size is the vocabulary's), grouped by unit into lattice edges, and
folded with the higher-order aggregate. For a unigram model the fold is Viterbi. For a BPE model,
whose encoding is not the best path of any sum of scores, Viterbi gives other ids than the model's
own; there the fold merges: its state is the bit set of boundaries, and each step removes the boundary
inside the best-scored edge that spans exactly two current pieces, the leftmost of equals. Characters
without a piece become their UTF-8 bytes' pieces.

encode(): the dictionary, of MAX_WORDS units at most, is packed by the executors into a few files that
Spark copies to each executor; texts are cut, looked up and put together as arrays (unit_table). Units
beyond it, and units longer than MAX_UNIT, are encoded in the worker by the same rule from a heap, so
ids don't depend on the bound. A lattice of all units would need no bound, but its rows don't fit the
disk. Each text's ids are decoded again, and round_trip says whether that gives the text.

Defined results: a null or empty text has no ids and decodes to an empty text (null stays null in
ids); repeated rows are encoded each; a text that itself has U+2581 decodes to spaces there; special
pieces' strings in a text are ordinary text; ids that the model lacks decode to nothing.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import SparkFiles
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, IntegerType, StringType, StructField, StructType

from strandmill.llm.shared import cut, free_name, in_worker, ship_bytes, tidy
from strandmill.llm.unit_table import CHUNK, LETTER, MARK, MARKED, OTHER, Units, UnitTable, kinds, segments, spread

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
MAX_UNIT, MAX_WORDS, EACH, PARTS, CACHE = 48, 250_000, 100_000, 16, 50_000
LATTICE_TASKS, SHORT = 24, 40


class Vocabulary:
    """Pieces of a model. kind: bpe or unigram. Small: it goes to the workers whole."""

    def __init__(self, pieces: list[tuple[str, int, float]], byte_ids: dict[int, int], unknown: int, kind: str = "bpe", specials: tuple[int, ...] = ()):
        self.pieces, self.byte_ids, self.unknown, self.kind = pieces, byte_ids, unknown, kind
        self.longest = max((len(p) for p, _, _ in pieces), default=1)
        self.by_text = {p: (i, s) for p, i, s in pieces}
        self.scores = {p: s for p, _, s in pieces}
        self.floor = min((s for _, _, s in pieces), default=0.0) - 10
        self.fine = self._fine()
        self.bytes_of = {i: p.replace(MARK, " ").encode() for p, i, _ in pieces} | {i: bytes([b]) for b, i in byte_ids.items()} | {i: b"" for i in specials}
        each = [self.bytes_of.get(i, b"") for i in range(max(self.bytes_of, default=0) + 1)] + [b""]
        n = np.array([len(x) for x in each], np.int64)
        #: The pieces' bytes, where each id's begin, and their number; the last is of no id.
        self.flat = np.frombuffer(b"".join(each), np.uint8), np.cumsum(n) - n, n

    @classmethod
    def load(cls, path: str = MODEL, kind: str = "bpe") -> Vocabulary:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = model.get_piece_size()
        own = [i for i in range(n) if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))]
        bytes_ = {int(model.id_to_piece(i)[1:-1], 16): i for i in range(n) if model.is_byte(i)}
        specials = tuple(i for i in range(n) if model.is_control(i) or model.is_unknown(i))
        return cls([(model.id_to_piece(i), i, model.get_score(i)) for i in own], bytes_, model.unk_id(), kind, specials)

    def _fine(self) -> bool:
        """Whether no piece goes across a boundary of the finer cut."""
        kind = kinds()
        inner = {(int(kind[ord(a)]), int(kind[ord(b)])) for p, _, _ in self.pieces for a, b in zip(p, p[1:])}
        return inner <= {(MARKED, MARKED), (MARKED, LETTER), (MARKED, OTHER), (LETTER, LETTER), (OTHER, OTHER)}

    def fallback(self, char: str) -> list[int]:
        return [self.byte_ids[b] for b in char.encode("utf-8", "replace")] if self.byte_ids else [self.unknown]

    def encode_unit(self, unit: str) -> list[int]:
        """Ids of one unit of any length."""
        if self.kind != "bpe":
            return self._viterbi(unit)
        return self._merge_short(unit) if len(unit) <= SHORT else self._merge(unit)

    def _merge_short(self, unit: str) -> list[int]:
        """Merging with a list of adjacent pairs' scores, quicker than a heap for a few characters."""
        get, none = self.scores.get, -np.inf
        parts = list(unit)
        pairs = [get(a + b, none) for a, b in zip(parts, parts[1:])]
        while pairs and (best := max(pairs)) > none:
            k = pairs.index(best)
            parts[k : k + 2] = [parts[k] + parts[k + 1]]
            del pairs[k]
            if k:
                pairs[k - 1] = get(parts[k - 1] + parts[k], none)
            if k < len(pairs):
                pairs[k] = get(parts[k] + parts[k + 1], none)
        out: list[int] = []
        for piece in parts:
            hit = self.by_text.get(piece)
            out += [hit[0]] if hit else self.fallback(piece)
        return out

    def _merge(self, unit: str) -> list[int]:
        n = len(unit)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap: list[tuple[float, int, int, int]] = []

        def offer(a: int) -> None:
            b = after[a]
            if b < n and (hit := self.by_text.get(unit[a : after[b]] if after[b] - a <= self.longest else "")):
                heapq.heappush(heap, (-hit[1], a, b, after[b]))

        for a in range(n - 1):
            offer(a)
        gone = [False] * (n + 1)
        while heap:
            _, a, b, c = heapq.heappop(heap)
            if gone[a] or after[a] != b or b >= n or gone[b] or after[b] != c:
                continue
            gone[b] = True
            after[a] = c
            if c < n:
                before[c] = a
            offer(a)
            if before[a] >= 0:
                offer(before[a])
        out: list[int] = []
        a = 0
        while a < n:
            piece = unit[a : after[a]]
            hit = self.by_text.get(piece)
            out += [hit[0]] if hit else self.fallback(piece)
            a = after[a]
        return out

    def _viterbi(self, unit: str) -> list[int]:
        n = len(unit)
        best = [(0.0, 0)] + [(-np.inf, 0)] * n
        for end in range(1, n + 1):
            for start in range(max(0, end - self.longest), end):
                hit = self.by_text.get(unit[start:end])
                score = hit[1] if hit else self.floor if end - start == 1 else None
                if score is not None and best[start][0] + score > best[end][0]:
                    best[end] = (best[start][0] + score, start)
        out: list[int] = []
        end = n
        while end:
            start = best[end][1]
            hit = self.by_text.get(unit[start:end])
            out = ([hit[0]] if hit else self.fallback(unit[start:end])) + out
            end = start
        return out

    def decode_all(self, ids: np.ndarray, offsets: np.ndarray) -> list[str]:
        """The text of each run of ids; an id that the model lacks has none."""
        flat, at, n = self.flat
        ids = np.where((ids >= 0) & (ids < len(n) - 1), ids, len(n) - 1)
        ends = np.concatenate([[0], np.cumsum(n[ids])])[offsets].tolist()
        data = spread(flat, at[ids], n[ids]).tobytes()
        texts = (data[a:b].decode("utf-8", "replace") for a, b in zip(ends, ends[1:]))
        return [t[1:] if t.startswith(" ") else t for t in texts]

    def decode(self, ids: list[int]) -> str:
        return self.decode_all(np.array(ids, np.int64), np.array([0, len(ids)]))[0]


def lattice(words: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """words: unit. Returns unit and edges: array of (score, start, stop, id, ends, inner) of the unit's substrings that are
    pieces, single characters without a piece with id null; best score first, then the leftmost."""
    spark = words.sparkSession
    table = F.broadcast(spark.createDataFrame([(p, i, float(s)) for p, i, s in vocabulary.pieces], "piece string, id int, score double"))
    n = F.length("unit")
    spans = F.flatten(F.transform(F.sequence(F.lit(0), n - 1), lambda a: F.transform(F.sequence(F.lit(1), F.least(F.lit(vocabulary.longest), n - a)), lambda k: F.struct(a.alias("start"), k.alias("n")))))
    parts = words.select("unit", F.explode(spans).alias("at")).select("unit", "at.start", (F.col("at.start") + F.col("at.n")).alias("stop"), F.expr("substring(unit, at.start + 1, at.n)").alias("piece"))
    found = parts.join(table, "piece", "left").where("id is not null or stop - start = 1")
    bit = lambda k: F.expr(f"shiftleft(1L, {k})")
    edge = F.struct(
        F.coalesce(-F.col("score"), F.lit(float("inf"))).alias("cost"), "start", "stop", "id",
        (bit("start") + bit("stop")).alias("ends"), (bit("stop") - F.lit(2).cast("long") * bit("start")).alias("inner"),
    )
    return found.groupBy("unit").agg(F.array_sort(F.collect_list(edge)).alias("edges"))


def merge_fold(unit: Column, edges: Column) -> Column:
    """The edges that are pieces at the end of merging: boundaries are bits 0 to n of the state."""
    longer = F.filter(edges, lambda e: e["inner"] != 0)
    start = F.struct((F.expr("shiftleft(1L, length(unit) + 1)") - 1).alias("mask"), F.lit(False).alias("done"))

    def step(a: Column, _: Column) -> Column:
        inside = lambda e: a["mask"].bitwiseAND(e["inner"])
        fits = F.filter(longer, lambda e: (a["mask"].bitwiseAND(e["ends"]) == e["ends"]) & (inside(e) != 0) & (inside(e).bitwiseAND(inside(e) - 1) == 0))
        first = F.get(fits, F.lit(0))
        return F.when(a["done"], a).otherwise(F.struct(F.coalesce(a["mask"].bitwiseXOR(a["mask"].bitwiseAND(first["inner"])), a["mask"]).alias("mask"), first["inner"].isNull().alias("done")))

    mask = F.when(F.size(longer) == 0, start["mask"]).otherwise(F.aggregate(F.sequence(F.lit(1), F.length(unit)), start, step, lambda a: a["mask"]))
    whole = lambda m: F.filter(edges, lambda e: (m.bitwiseAND(e["ends"]) == e["ends"]) & (m.bitwiseAND(e["inner"]) == 0))
    chosen = F.get(F.transform(F.array(mask), whole), F.lit(0))
    return F.array_sort(F.transform(chosen, lambda e: F.struct(e["start"], e["stop"], e["id"])))


def viterbi_fold(unit: Column, edges: Column, floor: float) -> Column:
    """The edges of the path of the largest sum of scores; of equal sums the one with the longest last piece."""
    cost = lambda e: F.when(e["id"].isNull(), F.lit(-floor)).otherwise(e["cost"])
    empty = F.array(F.struct(F.lit(0.0).alias("cost"), F.lit(0).alias("start"), F.lit(0).alias("stop"), F.lit(None).cast("int").alias("id")))

    def step(best: Column, stop: Column) -> Column:
        into = F.transform(F.filter(edges, lambda e: e["stop"] == stop), lambda e: F.struct((F.get(best, e["start"])["cost"] + cost(e)).alias("cost"), e["start"].alias("start"), e["stop"].alias("stop"), e["id"].alias("id")))
        return F.array_append(best, F.array_min(into))

    best = F.aggregate(F.sequence(F.lit(1), F.length(unit)), empty, step)

    def back(a: Column, stop: Column) -> Column:
        b = F.get(a["best"], stop)
        return F.when(a["at"] == stop, F.struct(a["best"].alias("best"), b["start"].alias("at"), F.array_append(a["path"], F.struct(b["start"].alias("start"), b["stop"].alias("stop"), b["id"].alias("id"))).alias("path"))).otherwise(a)

    begin = lambda t: F.struct(t.alias("best"), F.length(unit).alias("at"), F.array().cast("array<struct<start:int,stop:int,id:int>>").alias("path"))
    path = F.transform(F.array(best), lambda t: F.aggregate(F.reverse(F.sequence(F.lit(1), F.length(unit))), begin(t), back, lambda a: a["path"]))
    return F.array_sort(F.get(path, F.lit(0)))


def with_ids(edged: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """unit and ids of lattices."""
    path = merge_fold(F.col("unit"), F.col("edges")) if vocabulary.kind == "bpe" else viterbi_fold(F.col("unit"), F.col("edges"), vocabulary.floor)
    if vocabulary.byte_ids:
        table = F.array(*[F.lit(vocabulary.byte_ids[b]) for b in range(256)])
        char = lambda s: F.encode(F.substring("unit", s["start"] + 1, s["stop"] - s["start"]), "UTF-8")
        other = lambda s: F.transform(F.sequence(F.lit(1), F.octet_length(char(s))), lambda k: F.get(table, F.conv(F.hex(F.substring(char(s), k, F.lit(1))), 16, 10).cast("int")))
    else:
        other = lambda s: F.array(F.lit(vocabulary.unknown))
    ids = F.flatten(F.transform("path", lambda s: F.when(s["id"].isNotNull(), F.array(s["id"])).otherwise(other(s))))
    return edged.select("unit", path.alias("path")).select("unit", ids.alias("ids"))


def frequent_units(docs: DataFrame, vocabulary: Vocabulary, text_col: str = "text", each: int = EACH) -> DataFrame:
    """unit, n: units of up to MAX_UNIT characters that partitions have twice at least, each partition's `each`
    most frequent, with the sums of their counts. Partitions count all of their units; from 2 * each units on,
    those seen once since the last time go, so memory is bounded (lossy counting)."""
    schema = pa.schema([("unit", pa.string()), ("n", pa.int64())])

    def run(tables: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[int, int] = {}
        named: dict[int, str] = {}  # the unit of each digest; should two share one, they count as the first
        for table in tables:
            for low, high in in_bounds(table["text"]):
                parts = [p for t in table["text"][low:high].to_pylist() if t for p in segments(t)]
                units = Units(parts, vocabulary.fine)
                for d, at, n in zip(*(x.tolist() for x in np.unique(units.digests(), return_index=True, return_counts=True))):
                    if d in counts:
                        counts[d] += n
                    else:
                        counts[d], named[d] = n, units.unit(at)
                if len(counts) > 2 * each:
                    counts = {d: n for d, n in counts.items() if n > 1}
                    if len(counts) > each:
                        counts = dict(heapq.nlargest(each, counts.items(), key=lambda x: x[1]))
                    named = {d: named[d] for d in counts}
        top = [(named[d], n) for d, n in heapq.nlargest(each, counts.items(), key=lambda x: x[1]) if n > 1 and len(named[d]) <= MAX_UNIT]
        yield pa.RecordBatch.from_arrays([pa.array([u for u, _ in top], pa.string()), pa.array([n for _, n in top], pa.int64())], schema=schema)

    found = docs.select(F.col(text_col).alias("text")).mapInArrow(tidy(run), "unit string, n long")
    return found.groupBy("unit").agg(F.sum("n").alias("n"))


def dictionary(docs: DataFrame, vocabulary: Vocabulary, text_col: str = "text", most: int = MAX_WORDS) -> DataFrame:
    """unit, ids of the corpus's frequent units, at most `most`: those counted at least as often as the lowest
    count that keeps within it."""
    counted = cut(frequent_units(docs, vocabulary, text_col))
    by_count = counted.groupBy(F.least("n", F.lit(100_000)).alias("n")).agg(F.count(F.lit(1)).alias("units")).collect()
    total, floor = 0, 100_001
    for row in sorted(by_count, key=lambda r: -r["n"]):
        total += row["units"]
        if total > most:
            break
        floor = row["n"]
    words = counted.where(F.col("n") >= floor).select("unit").repartition(LATTICE_TASKS, "unit")
    return with_ids(lattice(words, vocabulary), vocabulary)


def ship(words: DataFrame, vocabulary: Vocabulary) -> list[str]:
    """Packs the dictionary into PARTS files in the shared folder and has Spark copy them to each executor; the driver
    holds one part at a time. Returns their names."""
    spark = words.sparkSession
    schema = pa.schema([("data", pa.binary())])

    def pack(tables: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        units, ids = [], []
        for t in tables:
            units += t["unit"].to_pylist()
            ids += t["ids"].to_pylist()
        if units:
            yield pa.RecordBatch.from_pydict({"data": [UnitTable.pack(units, ids, vocabulary.fine)]}, schema)

    packed = cut(words.select("unit", "ids").repartition(PARTS, "unit").mapInArrow(pack, "data binary"))
    return [ship_bytes(spark, "units", bytes(row["data"])) for row in packed.toLocalIterator()]


def shipped(names: list[str]) -> UnitTable:
    """The table of shipped files."""
    return UnitTable(Path(SparkFiles.get(n)).read_bytes() for n in names)


class Encoder:
    """Encodes texts in a worker from the shipped dictionary; remembers up to CACHE other units."""

    def __init__(self, vocabulary: Vocabulary, table: UnitTable):
        self.v, self.table = vocabulary, table
        self.known: dict[str, int] = {}
        self.forget()

    def forget(self) -> None:
        self.known.clear()
        self.ids, self.id_at, self.id_n = [], [], []
        self.total = len(self.table.ids)

    def others(self, units: Units, missing: np.ndarray) -> np.ndarray:
        """Places among the remembered units of those without an entry in the table."""
        if len(self.known) > CACHE:
            self.forget()
        out = np.empty(len(missing), np.int64)
        for k, at in enumerate(missing.tolist()):
            unit = units.unit(at)
            place = self.known.get(unit)
            if place is None:
                ids = self.v.encode_unit(unit)
                place = self.known[unit] = len(self.id_n)
                self.ids += ids
                self.id_at.append(self.total)
                self.id_n.append(len(ids))
                self.total += len(ids)
            out[k] = place
        return out

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, flat, and their offsets. An empty text has none."""
        parts, own = [], []
        for k, text in enumerate(texts):
            if text:
                parts += segments(text)
                own += [k] * (len(parts) - len(own))
        units = Units(parts, self.v.fine)
        found = self.table.find(units)
        missing = np.flatnonzero(found < 0)
        at, n = (self.table.id_at[found], self.table.id_n[found]) if len(self.table.id_n) else (np.zeros(len(found), np.int64),) * 2
        at, n = at.copy(), n.copy()
        pool = self.table.ids
        if len(missing):
            place = self.others(units, missing)
            at[missing], n[missing] = np.array(self.id_at)[place], np.array(self.id_n)[place]
            pool = np.concatenate([pool, np.array(self.ids, np.int32)])
        counts = np.zeros(len(texts), np.int64)
        ends = np.concatenate([[0], np.cumsum(n)])[units.bounds]
        np.add.at(counts, np.array(own, np.int64), np.diff(ends))
        return spread(pool, at, n), np.concatenate([[0], np.cumsum(counts)])


def in_bounds(texts: pa.Array, most: int = CHUNK) -> Iterator[tuple[int, int]]:
    """(start, stop) of runs of texts with about `most` bytes together, one text at least."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False))
    low = 0
    while low < len(ends):
        high = max(low + 1, int(np.searchsorted(ends, (ends[low - 1] if low else 0) + most, "right")))
        yield low, high
        low = high


def encode(docs: DataFrame, vocabulary: Vocabulary, text_col: str = "text", keep: tuple[str, ...] = ("doc_id",), names: list[str] | None = None, most: int = MAX_WORDS) -> DataFrame:
    """The keep columns, ids, and round_trip: whether decoding the ids gives the text (null for a null text)."""
    names = ship(dictionary(docs, vocabulary, text_col, most), vocabulary) if names is None else names
    result = StructType([StructField("ids", ArrayType(IntegerType())), StructField("round_trip", BooleanType())])

    def run(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        encoder = Encoder(vocabulary, shipped(names))
        for column in columns:
            for low, high in in_bounds(column):
                texts = column[low:high].to_pylist()
                ids, offsets = encoder.encode([t or "" for t in texts])
                same = [None if t is None else t == b for t, b in zip(texts, vocabulary.decode_all(ids, offsets))]
                none = np.array([t is None for t in texts] + [False])
                lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32(), mask=none), pa.array(ids, pa.int32()))
                yield pa.StructArray.from_arrays([lists, pa.array(same, pa.bool_())], ["ids", "round_trip"])

    coded, name = in_worker(run, result), free_name(docs, "coded")
    return docs.select(*keep, coded(F.col(text_col)).alias(name)).select(*keep, f"{name}.ids", f"{name}.round_trip")


def decode(encoded: DataFrame, vocabulary: Vocabulary, ids_col: str = "ids", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The keep columns and text of encoded rows; null ids give a null text."""

    def run(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in columns:
            lists = column.to_pylist()
            flat = np.array([x for i in lists for x in i or ()], np.int64)
            texts = vocabulary.decode_all(flat, np.concatenate([[0], np.cumsum([len(i or ()) for i in lists])]).astype(np.int64))
            yield pa.array([None if i is None else t for i, t in zip(lists, texts)], pa.string())

    text = in_worker(run, StringType())
    return encoded.select(*keep, text(F.col(ids_col)).alias("text"))
