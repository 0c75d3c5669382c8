"""N-gram Jaccard join by MinHash banding, with exact verification on full n-gram sets.

Texts are cut at U+0020 and U+0009 to U+000D into words and into sets of GRAM-word shingles, held as
64-bit hashes; a text of fewer words is one shingle of them all. Texts of the same set are one node.
Rows and bands of the signature are chosen for the target recall at the threshold; nodes that share
a band hash are candidates. Candidate components are verified whole, in blocks: every pair of nodes
of a component has its Jaccard similarity counted exactly, in one task for small components and in
one task per pair of blocks for large ones. A task returns per node its number of links and its root
among the links it saw, never pairs; the roots make the classes.

Defined results: a null, empty or blank text has no shingles and links to nothing; exact copies
always link; the class id is the smallest doc_id of the class; n_links counts the other rows that a
row links to, copies included; repeated rows are copies; a null doc_id keeps its class's id. Where one row
of each class is kept, rows are told apart by id and text, so null and repeated ids lose no class.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandmill.llm.components import connected, split_join
from strandmill.llm.shared import SPACE, cut, tidy

GRAM, THRESHOLD, RECALL, MAX_HASHES = 5, 0.8, 0.9999, 192
#: Nodes of a block, and hashes handled at a time.
BLOCK, CHUNK = 1024, 1 << 16
#: Shingles of a block, or of the small components of a task, about.
BLOCK_GRAMS = 1 << 20
CACHE = 1 << 16
_MIX, _BASE = np.uint64(0x9E3779B97F4A7C15), 0x100000001B3


def choose_bands(threshold: float = THRESHOLD, recall: float = RECALL, most: int = MAX_HASHES) -> tuple[int, int]:
    """(bands, rows): the most rows per band whose bands reach the recall at the threshold within most hashes."""
    for rows in range(most, 0, -1):
        bands = max(1, math.ceil(math.log(1 - recall) / math.log1p(-min(threshold**rows, 1 - 1e-12))))
        if bands * rows <= most:
            return bands, rows
    return most, 1


class Shingler:
    """Shingle hashes of texts; word hashes are remembered up to CACHE words."""

    def __init__(self, gram: int = GRAM):
        self.gram, self.known = gram, {}
        self.powers = [np.uint64(pow(_BASE, gram - 1 - k, 1 << 64)) for k in range(gram)]

    def word_hashes(self, words: list[bytes]) -> list[int]:
        known, make = self.known, xxhash.xxh64_intdigest
        if len(known) > CACHE:
            known.clear()
        out = []
        for w in words:
            h = known.get(w)
            if h is None:
                h = known[w] = make(w)
            out.append(h)
        return out

    @staticmethod
    def mixed(h: np.ndarray) -> np.ndarray:
        h = (h ^ (h >> np.uint64(29))) * _MIX
        return h ^ (h >> np.uint64(32))

    def shingles(self, text: bytes | None) -> np.ndarray:
        """Hashes of a text's shingles in order of place, repeats included."""
        words = (text or b"").split()
        n, g = len(words), self.gram
        if not n:
            return np.empty(0, np.uint64)
        h = np.array(self.word_hashes(words), np.uint64)
        if n < g:
            return self.mixed(np.array([xxhash.xxh64_intdigest(h.tobytes(), n)], np.uint64))
        total = np.zeros(n - g + 1, np.uint64)
        for k, p in enumerate(self.powers):
            total += h[k : n - g + 1 + k] * p
        return self.mixed(total)


def marks(text_col: str) -> dict[str, Column]:
    """Two 64-bit hashes of a text, which with its id name a row."""
    return {"mark": F.xxhash64(text_col), "mark2": F.xxhash64(F.lit(2), text_col)}


def signatures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", gram: int = GRAM, threshold: float = THRESHOLD, recall: float = RECALL, marked: bool = False) -> DataFrame:
    """doc_id, n (distinct shingles), key (128-bit hash of the set), bands (hashes); if marked the text's marks too."""
    bands, rows = choose_bands(threshold, recall)
    draw = np.random.default_rng(20240607)
    a = draw.integers(0, 1 << 63, bands * rows, np.uint64) * np.uint64(2) + np.uint64(1)
    b = draw.integers(0, 1 << 63, bands * rows, np.uint64)
    named = list(marks(text_col)) if marked else []
    schema = pa.schema([("doc_id", pa.int64()), ("n", pa.int32()), ("key", pa.binary()), ("bands", pa.list_(pa.int64())), *[(c, pa.int64()) for c in named]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(gram)

        def flush(ids: list, sets: list[np.ndarray], rest: list[pa.Array]) -> pa.RecordBatch:
            sizes = np.array([len(s) for s in sets])
            keys = [xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets]
            full = np.flatnonzero(sizes)
            lists: list[list[int] | None] = [None] * len(sets)
            if len(full):
                joined = np.concatenate([sets[k] for k in full])
                starts = np.concatenate([[0], np.cumsum(sizes[full])[:-1]])
                least = np.empty((len(full), bands * rows), np.uint64)
                for k in range(bands * rows):
                    least[:, k] = np.minimum.reduceat(joined * a[k] + b[k], starts)
                folded = np.zeros((len(full), bands), np.uint64)
                least = least.reshape(len(full), bands, rows)
                for r in range(rows):
                    folded = Shingler.mixed(folded * np.uint64(_BASE) + least[:, :, r])
                folded = Shingler.mixed(folded + np.arange(1, bands + 1, dtype=np.uint64) * _MIX).view(np.int64)
                for at, k in enumerate(full.tolist()):
                    lists[k] = folded[at]
            return pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(sizes, pa.int32()), pa.array(keys, pa.binary()), pa.array(lists, pa.list_(pa.int64())), *rest], schema=schema)

        for batch in batches:
            ids, sets, total, done = [], [], 0, 0
            rest = lambda: [batch[c].slice(done, len(ids)) for c in named]  # noqa: B023, E731
            for i, text in zip(batch["doc_id"].to_pylist(), batch["text"]):
                ids.append(i)
                sets.append(np.unique(shingler.shingles(text.as_py())))
                total += len(sets[-1])
                if total >= CHUNK:
                    yield flush(ids, sets, rest())
                    ids, sets, total, done = [], [], 0, done + len(ids)
            if ids:
                yield flush(ids, sets, rest())

    rows_in = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("binary").alias("text"), *[c.alias(n) for n, c in marks(text_col).items() if marked])
    return rows_in.mapInArrow(tidy(run), ", ".join(["doc_id long, n int, key binary, bands array<long>", *[f"{c} long" for c in named]]))


def _sets(docs: DataFrame, gram: int) -> DataFrame:
    """doc_id, key and the distinct shingle hashes as bytes."""
    schema = pa.schema([("doc_id", pa.int64()), ("key", pa.binary()), ("grams", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(gram)
        for batch in batches:
            grams = [np.unique(shingler.shingles(t.as_py())).tobytes() for t in batch["text"]]
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array([xxhash.xxh3_128_digest(g) for g in grams], pa.binary()), pa.array(grams, pa.binary())], schema=schema)

    return docs.mapInArrow(tidy(run), "doc_id long, key binary, grams binary")


def overlaps(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of all pairwise intersections, from products of 0/1 matrices over the shingles that two sets at least have."""
    n = len(sets)
    rows = np.repeat(np.arange(n, dtype=np.int32), [len(s) for s in sets])
    names, columns, counts = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = counts[columns] > 1
    place = np.cumsum(counts > 1, dtype=np.int64) - 1
    rows, columns, names = rows[shared], place[columns[shared]], int((counts > 1).sum())
    order = np.argsort(columns, kind="stable")
    rows, columns = rows[order], columns[order]
    common = np.zeros((n, n), np.float32)
    for low in range(0, names, 1024):
        a, b = np.searchsorted(columns, [low, low + 1024])
        part = np.zeros((n, min(1024, names - low)), np.float32)
        part[rows[a:b], columns[a:b] - low] = 1
        for strip in range(0, n, 256):
            common[strip : strip + 256] += part[strip : strip + 256] @ part.T
    return common


def linked_in(sets: list[np.ndarray], block: np.ndarray, threshold: float) -> np.ndarray:
    """Boolean matrix of links; block: of two different blocks only pairs across count, of one block all."""
    size = np.array([len(s) for s in sets], np.float64)
    common = overlaps(sets)
    links = np.empty(common.shape, bool)
    for low in range(0, len(sets), 256):
        part = common[low : low + 256].astype(np.float64)
        links[low : low + 256] = part >= threshold * (size[low : low + 256, None] + size[None, :] - part) - 1e-9
    np.fill_diagonal(links, False)
    if len(np.unique(block)) > 1:
        links &= block[:, None] != block[None, :]
    return links


def _verify(group: pd.DataFrame, threshold: float) -> pd.DataFrame:
    out = []
    for _, part in group.drop_duplicates(["comp", "key"]).groupby("comp", sort=False):
        part = part.sort_values("key", kind="stable")
        keys, i, j = part["key"].tolist(), part["i"].iloc[0], part["j"].iloc[0]
        if i != j and part["block"].nunique() < 2:
            continue
        links = linked_in([np.frombuffer(g, np.uint64) for g in part["grams"]], part["block"].to_numpy(), threshold)
        copies = part["copies"].to_numpy(np.int64)
        counts = np.array([copies[row].sum() for row in links], np.int64)
        root = np.full(len(keys), -1)
        for s in range(len(keys)):
            if root[s] < 0:
                root[s], front = s, np.array([s])
                while len(front):
                    front = np.flatnonzero(links[front].any(axis=0) & (root < 0))
                    root[front] = s
        out.append(pd.DataFrame({"key": keys, "links": counts, "to": [keys[r] for r in root]}))
    return pd.concat(out) if out else pd.DataFrame({"key": [], "links": np.array([], np.int64), "to": []})


def linked(docs: DataFrame, id_col: str, text_col: str, gram: int, threshold: float, recall: float, marked: bool = False) -> tuple[DataFrame, DataFrame]:
    """The signatures, and the nodes: key, root (their class), rep, copies, links; if marked the first row of each, by id and marks."""
    sigs = cut(signatures(docs, id_col, text_col, gram, threshold, recall, marked))
    first = [F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", *marks(text_col))).alias("first")] if marked else []
    keys = cut(sigs.where("n > 0").groupBy("key").agg(F.min("doc_id").alias("rep"), F.max("n").alias("n"), F.count(F.lit(1)).alias("copies"), *first))
    of_rep = keys.select(F.col("key").alias("k"), "rep")
    banded = cut(sigs.where("n > 0").join(of_rep, (F.col("key") == F.col("k")) & F.col("doc_id").eqNullSafe(F.col("rep"))).select("key", F.explode("bands").alias("band")))
    leaders = banded.groupBy("band").agg(F.min("key").alias("leader"), F.max("key").alias("last"), F.count(F.lit(1)).alias("rows_of_key")).where("leader <> last").drop("last")
    candidates = split_join(banded, leaders, "band", banded.count()).where("key <> leader").select(F.col("key").alias("u"), F.col("leader").alias("v"))
    comps = cut(connected(candidates))
    placed = cut(comps.join(keys.select("key", "rep", "n", "copies"), F.col("node") == F.col("key")).select(F.col("root").alias("comp"), "key", "rep", "n", "copies"))
    sizes = placed.groupBy("comp").agg(F.count(F.lit(1)).alias("rows_of_key"), F.greatest(F.ceil(F.count(F.lit(1)) / BLOCK), F.ceil(F.sum("n") / BLOCK_GRAMS)).cast("int").alias("blocks"))
    whole = placed.agg(F.count(F.lit(1)).alias("nodes"), F.coalesce(F.sum("n"), F.lit(0)).alias("grams")).head()
    members = split_join(placed, sizes, "comp", whole["nodes"]).withColumn("block", F.pmod(F.xxhash64("key"), F.col("blocks")).cast("int"))
    wanted = members.select("rep").distinct()
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("binary").alias("text"))
    sets = _sets(texts.join(wanted, F.col("doc_id").eqNullSafe(F.col("rep")), "left_semi"), gram)
    loaded = members.withColumnRenamed("key", "k").drop("n").join(sets, (F.col("doc_id").eqNullSafe(F.col("rep"))) & (F.col("k") == F.col("key"))).drop("k", "doc_id", "rep")
    buckets = max(1, math.ceil(whole["nodes"] / BLOCK), math.ceil(whole["grams"] / BLOCK_GRAMS))
    dealt = loaded.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "comp", "key", "copies", "grams", "block", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"),
        F.when(F.col("blocks") == 1, F.pmod(F.xxhash64("comp"), F.lit(buckets))).otherwise(F.xxhash64("comp")).alias("bucket"),
    )
    seen = cut(dealt.groupBy("bucket", "i", "j").applyInPandas(lambda g: _verify(g, threshold), "key binary, links long, to binary"))
    classes = connected(seen.select(F.col("key").alias("u"), F.col("to").alias("v")))
    linked = seen.groupBy("key").agg(F.sum("links").alias("links"))
    nodes = keys.join(linked, "key", "left").join(classes, F.col("key") == F.col("node"), "left").withColumn("root", F.coalesce("root", "key")).drop("node")
    return sigs, nodes


def join(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", gram: int = GRAM, threshold: float = THRESHOLD, recall: float = RECALL) -> DataFrame:
    """One row per input row: doc_id, class_id, n_links."""
    sigs, nodes = linked(docs, id_col, text_col, gram, threshold, recall)
    nodes = cut(nodes.select("key", "root", "rep", "copies", "links"))
    named = nodes.groupBy("root").agg(F.min("rep").alias("class_id"), F.count(F.lit(1)).alias("rows_of_key"))
    total = sigs.count()
    nodes = split_join(nodes, named, "root", total).select("key", "class_id", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.col("copies").alias("rows_of_key"))
    found = split_join(sigs.where("n > 0").select("doc_id", "key"), nodes, "key", total).select("doc_id", F.coalesce("class_id", "doc_id").alias("class_id"), F.col("n_links").cast("long").alias("n_links"))
    return found.unionByName(sigs.where("n = 0").select("doc_id", F.col("doc_id").alias("class_id"), F.lit(0).cast("long").alias("n_links")))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs with one row of each class: that of its smallest id, null ids last, then of the smallest hash of the text.
    A text without words is a class of its own, so every such row stays."""
    _, nodes = linked(docs, id_col, text_col, GRAM, THRESHOLD, RECALL, True)
    kept = nodes.groupBy("root").agg(F.min("first").alias("w")).select(F.col("w.none").alias("k0"), F.coalesce("w.doc_id", F.lit(0)).alias("k1"), F.col("w.mark").alias("k2"), F.col("w.mark2").alias("k3"))
    number = F.col(id_col).cast("long")
    keys = dict(zip(["r0", "r1", "r2", "r3"], [number.isNull(), F.coalesce(number, F.lit(0)), *marks(text_col).values()]))
    # the rows go as one struct, so no column of docs can clash
    rows = docs.select(F.struct("*").alias("row"), F.coalesce(F.col(text_col).rlike(rf"[^{SPACE}]"), F.lit(False)).alias("worded"), *[c.alias(r) for r, c in keys.items()])
    # one dealing of the texts serves the join and the choice among rows of the same id and text
    chosen = rows.where("worded").join(kept, [F.col(r) == F.col(r.replace("r", "k")) for r in keys], "left_semi").dropDuplicates(list(keys))
    return chosen.unionByName(rows.where(~F.col("worded"))).select("row.*")
