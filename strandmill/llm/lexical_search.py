"""Ranked lexical search by TPUT (three-phase uniform threshold) over term-partitioned postings.

Documents are numbered within blocks of BLOCK_DOCS; a block has, for each term, one list of places and
impacts, largest impact first, packed. Lists are stored partitioned by term; those of a term with
many blocks are dealt to several partitions. An impact is (1e9 * tf) div (1000 * tf + 12 * m), a list
counts weight times impact for a query, its weight being the term's times its repeats in the query.

Phase 1 fetches the HEAD largest entries of each term's list; the scores of the documents seen there,
of which the K-th of a query is its lower bound. Phase 2 gives every list of a query the same
threshold: the highest T such that lists cut off at T can't together pass the bound, times SHARE. Entries at T
or above go to their document's block, where a document's upper bound adds what each list could still
hold below T; those that reach the lower bound are candidates. Phase 3 looks the candidates' entries
up in all lists and ranks exact scores.

Queries go in blocks of about QUERY_PAIRS terms: what a block ships to workers is bounded by that times HEAD.
Up to TERMS distinct query terms only their lists are built; beyond it, all lists.

Defined results: a null text has no terms; documents without terms count in nothing; each row is a
document of its own, ids repeated or null (last among equal scores); an item repeated with its text is
asked once, and one repeated with other texts has a list of each; an item without terms that documents
hold, a null one too, has no rows; an empty table gives none.
"""

from __future__ import annotations

import math
import pickle
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import SparkFiles, TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from strandmill.llm.shared import cut, fresh_path, ship_bytes, tidy
from strandmill.llm.words import word_slices

BLOCK_DOCS, BLOCK_WORDS = 4096, 1 << 22
HEAD, SHARE, K = 32, 0.5, 20
QUERY_PAIRS, TERMS = 50_000, 1_000_000
RAW = "block long, term binary, size int, at binary, tf binary, words binary, ids array<long>, holding long, total long"
LISTS = "block long, term binary, size int, at binary, impact binary, most int, ids array<long>"


def terms_of(text: bytes) -> Counter:
    found: Counter = Counter()
    for words in word_slices(text):
        found.update(words)
    return found


def _batch(schema: str, columns: dict[str, list]) -> pa.RecordBatch:
    kinds = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary(), "array<long>": pa.list_(pa.int64())}
    return pa.RecordBatch.from_arrays([pa.array(columns[c], kinds[k]) for c, k in (f.split(" ") for f in schema.split(", "))], names=list(columns))


def invert(docs: DataFrame, wanted: str | None) -> DataFrame:
    """docs: doc_id, text as binary. RAW rows: a list for each block and term (of the shipped file wanted, or any),
    and for each block a row without term: its ids (at: places of null ones), documents that hold terms, and terms with repeats."""

    def block(number: int, ids: list, counts: list[int], owners: list[int], numbers: list[int], tfs: list[int], names: list[bytes]) -> pa.RecordBatch:
        rows: dict[str, list] = {f.split(" ")[0]: [] for f in RAW.split(", ")}
        words = np.array(counts, np.uint32)
        owner = np.repeat(np.arange(len(ids), dtype=np.uint32), owners)
        term, tf = np.array(numbers, np.int64), np.array(tfs, np.uint32)
        order = np.argsort(term, kind="stable")
        term, owner, tf = term[order], owner[order], tf[order]
        starts = np.flatnonzero(np.append(True, term[1:] != term[:-1])) if len(term) else np.array([], int)
        for low, high in zip(starts, np.append(starts[1:], len(term))):
            values = (number, names[term[low]], len(ids), owner[low:high].tobytes(), tf[low:high].tobytes(), words[owner[low:high]].tobytes(), None, int(high - low), None)
            for column, value in zip(rows.values(), values):
                column.append(value)
        none = np.flatnonzero([x is None for x in ids]).astype(np.uint32).tobytes()
        for column, value in zip(rows.values(), (number, None, len(ids), none, None, None, [x or 0 for x in ids], int((words > 0).sum()), int(words.sum(dtype=np.int64)))):
            column.append(value)
        return _batch(RAW, rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[bytes, int] | None = None
        if wanted is not None:
            with open(SparkFiles.get(wanted), "rb") as file:
                known = {t: k for k, t in enumerate(pickle.load(file))}
        number, total = TaskContext.get().partitionId() << 32, 0
        own: dict[bytes, int] = {} if known is None else known
        state: tuple = ([], [], [], [], [])
        for batch in batches:
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                found = terms_of(text.as_py() or b"")
                hits = found if known is None else found.keys() & own.keys()
                ids, counts, owners, numbers, tfs = state
                ids.append(key)
                counts.append(found.total())
                owners.append(len(hits))
                numbers.extend([own.setdefault(t, len(own)) for t in hits] if known is None else [own[t] for t in hits])
                tfs.extend([found[t] for t in hits])
                total += counts[-1]
                if len(ids) >= BLOCK_DOCS or total >= BLOCK_WORDS:
                    yield block(number, *state, list(own))
                    number, total, state, own = number + 1, 0, ([], [], [], [], []), {} if known is None else own
        if state[0]:
            yield block(number, *state, list(own))

    return docs.mapInArrow(tidy(run), RAW)


def middles(words: np.ndarray, holding: int, total: int) -> np.ndarray:
    """75 + (25 * words * holding) div total, exact at any size."""
    if 25 * int(words.max(initial=0)) * holding < 1 << 63:
        return 75 + (25 * words.astype(np.int64) * holding) // total
    distinct, back = np.unique(words, return_inverse=True)
    return np.array([75 + 25 * int(n) * holding // total for n in distinct], np.int64)[back]


def weighed(raw: DataFrame, holding: int, total: int) -> DataFrame:
    """LISTS rows: impacts in the place of counts, largest first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: dict[str, list] = {f.split(" ")[0]: [] for f in LISTS.split(", ")}
            for r in batch.to_pylist():
                at, impact, most = r["at"], None, None
                if r["term"] is not None:
                    tf = np.frombuffer(r["tf"], np.uint32).astype(np.int64)
                    value = 1_000_000_000 * tf // (1000 * tf + 12 * middles(np.frombuffer(r["words"], np.uint32), holding, total))
                    order = np.argsort(-value, kind="stable")
                    at, impact, most = np.frombuffer(r["at"], np.uint32)[order].tobytes(), value[order].astype(np.uint32).tobytes(), int(value.max())
                for column, v in zip(rows.values(), (r["block"], r["term"], r["size"], at, impact, most, r["ids"])):
                    column.append(v)
            yield _batch(LISTS, rows)

    return raw.select("block", "term", "size", "at", "tf", "words", "ids").mapInArrow(tidy(run), LISTS)


class Index:
    """Written lists, term counts, and the sums that weights need."""

    def __init__(self, lists: DataFrame, counts: DataFrame, holding: int):
        self.lists, self.counts, self.holding = lists, counts, holding

    @classmethod
    def build(cls, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", terms: DataFrame | None = None) -> Index:
        """terms: one column, the terms to index; None: all."""
        spark = docs.sparkSession
        wanted = None
        if terms is not None and (few := terms.limit(TERMS + 1).collect()) and len(few) <= TERMS:
            wanted = ship_bytes(spark, "terms", pickle.dumps([bytes(r[0]) for r in few]))
        folder = fresh_path(spark, "postings")
        invert(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("binary").alias("text")), wanted).write.parquet(f"{folder}/raw")
        raw = spark.read.parquet(f"{folder}/raw")
        sums = raw.where("term is null").agg(F.coalesce(F.sum("holding"), F.lit(0)).alias("holding"), F.coalesce(F.sum("total"), F.lit(0)).alias("total")).head()
        place = F.xxhash64(F.coalesce(F.col("term"), F.col("block").cast("string").cast("binary")), F.shiftright("block", 6) % 64)
        weighed(raw, sums["holding"], sums["total"]).repartition(place).sortWithinPartitions("term", "block").write.parquet(f"{folder}/lists")
        counts = raw.where("term is not null").groupBy("term").agg(F.sum("holding").alias("df"))
        return cls(spark.read.parquet(f"{folder}/lists"), counts, sums["holding"])


class Queries:
    """A block of queries: term k's queries and weights are pairs[starts[k] : starts[k + 1]]."""

    def __init__(self, items: list, terms: list[bytes], term: np.ndarray, query: np.ndarray, weight: np.ndarray):
        order = np.lexsort((query, term))
        self.items, self.terms = items, terms
        self.keys = list(range(len(items)))  # the queries' numbers over all blocks
        self.term, self.query, self.weight = term[order], query[order], weight[order]
        self.starts = np.searchsorted(self.term, np.arange(len(terms) + 1))
        self.number = {t: k for k, t in enumerate(terms)}
        self.low, self.floor = np.zeros(len(items), np.int64), np.zeros(len(items), np.int64)

    def by_query(self) -> list[tuple[np.ndarray, np.ndarray]]:
        """Of each query the terms and weights."""
        order = np.argsort(self.query, kind="stable")
        cuts = np.searchsorted(self.query[order], np.arange(len(self.items) + 1))
        return [(self.term[order[a:b]], self.weight[order[a:b]]) for a, b in zip(cuts, cuts[1:])]

    def needs(self) -> np.ndarray:
        """Of each pair the least impact that reaches its query's threshold."""
        return -(-self.low[self.query] // self.weight)

    def ship(self, lists: DataFrame, name: str, **more: np.ndarray) -> str:
        return ship_bytes(lists.sparkSession, name, pickle.dumps((self, more)))


def _load(name: str) -> tuple[Queries, dict]:
    with open(SparkFiles.get(name), "rb") as file:
        return pickle.load(file)


def heads(lists: DataFrame, name: str) -> DataFrame:
    """term (its number), impact, block, at: the HEAD largest of each term. Tasks send HEAD of a term at most."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries, _ = _load(name)
        best: dict[int, np.ndarray] = {}
        for batch in batches:
            for term, block, at, impact in zip(*(batch.column(c).to_pylist() for c in range(4))):
                if (k := queries.number.get(term)) is None:
                    continue
                own = np.stack([np.frombuffer(impact, np.uint32)[:HEAD].astype(np.int64), np.full(min(HEAD, len(at) // 4), block), np.frombuffer(at, np.uint32)[:HEAD].astype(np.int64)])
                if k in best:
                    own = np.hstack([best[k], own])
                    own = own[:, np.lexsort((own[2], own[1], -own[0]))[:HEAD]]
                best[k] = own
        if best:
            flat = np.hstack(list(best.values()))
            yield pa.RecordBatch.from_arrays([pa.array(np.repeat(list(best), [v.shape[1] for v in best.values()]), pa.int64()), *[pa.array(x, pa.int64()) for x in flat]], names=["term", "impact", "block", "at"])

    found = lists.where("term is not null").select("term", "block", "at", "impact").mapInArrow(tidy(run), "term long, impact long, block long, at long")
    first = Window.partitionBy("term").orderBy(F.desc("impact"), "block", "at")
    return found.withColumn("place", F.row_number().over(first)).where(F.col("place") <= HEAD).drop("place")


def exact(lists: DataFrame, name: str) -> DataFrame:
    """candidate, score: of the shipped candidates (block, query, at), summed over lists by task, then over tasks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries, more = _load(name)
        block, query, at = more["block"], more["query"], more["at"]  # in order of block
        score = np.zeros(len(block), np.int64)
        for batch in batches:
            for term, number, places, impact in zip(*(batch.column(c).to_pylist() for c in range(4))):
                if (k := queries.number.get(term)) is None:
                    continue
                low, high = np.searchsorted(block, [number, number + 1])
                pairs = slice(queries.starts[k], queries.starts[k + 1])
                asked, weight = queries.query[pairs], queries.weight[pairs]
                pair = np.minimum(np.searchsorted(asked, query[low:high]), len(asked) - 1)
                use = np.flatnonzero(asked[pair] == query[low:high])
                if not len(use):
                    continue
                places, impact = np.frombuffer(places, np.uint32), np.frombuffer(impact, np.uint32)
                order = np.argsort(places)
                spot = np.minimum(np.searchsorted(places, at[low + use], sorter=order), len(order) - 1)
                hit = places[order[spot]] == at[low + use]
                score[low + use[hit]] += weight[pair[use[hit]]] * impact[order[spot[hit]]].astype(np.int64)
        some = np.flatnonzero(score)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int64()), pa.array(score[some], pa.int64())], names=["candidate", "score"])

    found = lists.where("term is not null").select("term", "block", "at", "impact").mapInArrow(tidy(run), "candidate long, score long")
    return found.groupBy("candidate").agg(F.sum("score").alias("score"))


def thresholds(queries: Queries, most: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Of each query, SHARE of the highest T for which the lists' maxima, each T at most, add up to its bound at most; 1 at least."""
    out = np.ones(len(queries.items), np.int64)
    for q, (terms, weights) in enumerate(queries.by_query()):
        tops = np.sort(most[terms] * weights)
        low, high = 0, int(tops.max(initial=0)) + 1
        while low < high:
            middle = (low + high + 1) // 2
            low, high = (middle, high) if np.minimum(tops, middle).sum() <= bounds[q] else (low, middle - 1)
        out[q] = max(1, int(low * SHARE))
    return out


def fetch(lists: DataFrame, name: str, whole: bool) -> DataFrame:
    """block, term (number), size, at, impact, most: of each list the entries that reach a query's threshold, or all."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries, _ = _load(name)
        need = np.minimum.reduceat(queries.needs(), queries.starts[:-1]) if len(queries.terms) else None
        for batch in batches:
            rows: dict[str, list] = {c: [] for c in ("block", "term", "size", "at", "impact", "most")}
            for r in batch.to_pylist():
                if (k := queries.number.get(r["term"])) is None:
                    continue
                impact = np.frombuffer(r["impact"], np.uint32)
                n = len(impact) if whole else int(np.searchsorted(-impact.astype(np.int64), -need[k], "right"))
                for column, v in zip(rows.values(), (r["block"], k, r["size"], r["at"][: 4 * n], r["impact"][: 4 * n], r["most"])):
                    column.append(v)
            yield _batch("block long, term int, size int, at binary, impact binary, most int", rows)

    return lists.where("term is not null").select("block", "term", "size", "at", "impact", "most").mapInArrow(tidy(run), "block long, term int, size int, at binary, impact binary, most int")


def _unpacked(part: pd.DataFrame) -> dict[int, tuple[np.ndarray, np.ndarray, int]]:
    return {t: (np.frombuffer(a, np.uint32), np.frombuffer(i, np.uint32).astype(np.int64), m) for t, a, i, m in zip(part["term"], part["at"], part["impact"], part["most"])}


def candidates(fetched: DataFrame, name: str) -> DataFrame:
    """block, query, at (packed): the documents whose upper bound reaches their query's lower bound."""

    def run(part: pd.DataFrame) -> pd.DataFrame:
        queries, _ = _load(name)
        found, size = _unpacked(part), int(part["size"].iloc[0])
        query, at = [], []
        for q, (terms, weights) in enumerate(queries.by_query()):
            low, bound = int(queries.low[q]), np.zeros(size, np.int64)
            for t, w in zip(terms.tolist(), weights.tolist()):
                if t in found:
                    places, impact, most = found[t]
                    n = int(np.searchsorted(-impact, -(-(-low // w)), "right"))
                    rest = min(low - 1, w * most)  # what a document not seen in this list could have in it
                    bound += rest
                    bound[places[:n]] += w * impact[:n] - rest
            near = np.flatnonzero(bound >= max(1, int(queries.floor[q])))
            query.append(np.full(len(near), q, np.uint32))
            at.append(near.astype(np.uint32))
        return pd.DataFrame({"block": [part["block"].iloc[0]], "query": [np.concatenate(query).tobytes()], "at": [np.concatenate(at).tobytes()]})

    return fetched.groupBy("block").applyInPandas(run, "block long, query binary, at binary").where(F.length("at") > 0)


def looked_up(chosen: DataFrame, whole: DataFrame, ids: DataFrame, name: str, k: int) -> DataFrame:
    """query, item_id, doc_id, score: exact scores of the candidates that reach the lower bound, a block's k best of each query."""

    def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        queries, _ = _load(name)
        out: list[tuple] = []
        if len(left) and len(right):
            found, size = _unpacked(right[right["term"] >= 0]), int(right["size"].iloc[0])
            own_row = right[right["term"] < 0].iloc[0]
            names, none = own_row["ids"].tolist(), set(np.frombuffer(own_row["at"], np.uint32).tolist())
            query, at = np.frombuffer(left["query"].iloc[0], np.uint32), np.frombuffer(left["at"].iloc[0], np.uint32)
            cuts, every = np.searchsorted(query, np.arange(len(queries.items) + 1)), queries.by_query()
            for q in np.unique(query).tolist():
                own = at[cuts[q] : cuts[q + 1]]
                wanted, score = np.zeros(size, bool), np.zeros(size, np.int64)
                wanted[own] = True
                for t, w in zip(every[q][0].tolist(), every[q][1].tolist()):
                    if t in found:
                        inside = wanted[found[t][0]]
                        score[found[t][0][inside]] += w * found[t][1][inside]
                own = own[score[own] >= max(1, int(queries.floor[q]))]
                own = own[score[own] >= np.partition(score[own], -k)[-k]] if len(own) > k else own
                best = sorted((-int(score[x]), x in none, names[x]) for x in own.tolist())[:k]
                out += [(queries.keys[q], queries.items[q], None if last else key, -s) for s, last, key in best]
        return pd.DataFrame({"query": pd.array([o[0] for o in out], "Int64"), "item_id": pd.array([o[1] for o in out], "Int64"), "doc_id": pd.array([o[2] for o in out], "Int64"), "score": pd.array([o[3] for o in out], "Int64")})

    empty = F.lit(None)
    both = whole.withColumn("ids", empty.cast("array<long>")).unionByName(ids.select("block", F.lit(-1).alias("term"), "size", "at", empty.cast("binary").alias("impact"), empty.cast("int").alias("most"), "ids"))
    return chosen.groupBy("block").cogroup(both.groupBy("block")).applyInPandas(run, "query long, item_id long, doc_id long, score long")


def asked(items: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """query, item_id, term, repeats: the terms of each distinct item."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: dict[str, list] = {"query": [], "item_id": [], "term": [], "repeats": []}
            for q, key, text in zip(*(batch.column(c).to_pylist() for c in range(3))):
                for term, n in terms_of(text or b"").items():
                    for column, v in zip(rows.values(), (q, key, term, n)):
                        column.append(v)
            yield _batch("query long, item_id long, term binary, repeats long", rows)

    distinct = items.select(F.col(id_col).cast("long").alias("item_id"), F.col(text_col).cast("binary").alias("text")).where("text is not null").distinct()
    return cut(distinct.select(F.monotonically_increasing_id().alias("query"), "item_id", "text").mapInArrow(tidy(run), "query long, item_id long, term binary, repeats long"))


def _block(index: Index, pairs: DataFrame, k: int) -> DataFrame:
    """The three phases for one block of queries: query, item_id, term, repeats, weight."""
    rows = pairs.toPandas()
    numbers, query = np.unique(rows["query"], return_inverse=True)
    items: list = [None] * len(numbers)
    for q, item in zip(query, rows["item_id"]):
        items[q] = None if pd.isna(item) else int(item)
    names = sorted({bytes(t) for t in rows["term"]})
    place = {t: n for n, t in enumerate(names)}
    queries = Queries(items, names, np.array([place[bytes(t)] for t in rows["term"]], np.int64), query.astype(np.int64), (rows["repeats"] * rows["weight"]).to_numpy(np.int64))
    queries.keys = numbers.tolist()
    top = heads(index.lists, queries.ship(index.lists, "queries")).toPandas()
    most = np.zeros(len(names), np.int64)
    np.maximum.at(most, top["term"].to_numpy(), top["impact"].to_numpy())
    asked_by = pd.DataFrame({"term": queries.term, "query": queries.query})
    seen = top[["term", "block", "at"]].merge(asked_by, on="term")[["block", "query", "at"]].drop_duplicates().sort_values("block", kind="stable")
    shipped = queries.ship(index.lists, "heads", **{c: seen[c].to_numpy(np.int64) for c in seen})
    score = np.zeros(len(seen), np.int64)
    for row in exact(index.lists, shipped).toLocalIterator():
        score[row["candidate"]] = row["score"]
    order = np.lexsort((-score, seen["query"].to_numpy()))
    by = seen["query"].to_numpy()[order]
    first = np.searchsorted(by, np.arange(len(items) + 1))
    for q, (low, high) in enumerate(zip(first, first[1:])):
        queries.floor[q] = score[order[low + k - 1]] if high - low >= k else 0
    queries.low = thresholds(queries, most, queries.floor)
    name = queries.ship(index.lists, "thresholds")
    chosen = cut(candidates(fetch(index.lists, name, False), name))
    return looked_up(chosen, fetch(index.lists, name, True), index.lists.where("term is null"), name, k)


def search(docs: DataFrame, items: DataFrame, k: int = K, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """item_id, rank, doc_id, score: the k documents of the highest scores above 0 for each item."""
    pairs = asked(items, item_col, item_text)
    index = Index.build(docs, id_col, text_col, pairs.select("term").distinct())
    ratio = F.lit(float(2 * index.holding + 2)) / (2 * F.col("df") + 1).cast("double")
    weighted = cut(pairs.join(index.counts, "term").withColumn("weight", F.floor(1000 * F.log(ratio)).cast("long")).where("weight > 0"))
    blocks = math.ceil(weighted.count() / QUERY_PAIRS)
    found = docs.sparkSession.createDataFrame([], "query long, item_id long, doc_id long, score long")
    for b in range(blocks):
        found = found.unionByName(_block(index, weighted.where(F.pmod(F.xxhash64("query"), F.lit(blocks)) == b), k))
    order = Window.partitionBy("query").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
    return found.withColumn("rank", F.row_number().over(order).cast("int")).where(F.col("rank") <= k).select("item_id", "rank", "doc_id", "score")
