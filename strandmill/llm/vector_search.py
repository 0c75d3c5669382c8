"""Approximate nearest neighbours: a hierarchical navigable small-world graph per shard.

Vectors are dealt by length, a band for each power of two, and within a band by hash to shards of about
SHARD_ROWS rows; each shard builds its graph in one task and stores it as flat arrays: per layer the member
nodes and one array of neighbours, a fixed number a node, -1 where there are fewer. Bands of up to
EXACT_ROWS rows are pooled in shards without a graph, which are searched exactly. Queries are dealt in
blocks; each block searches each shard of its dimensions, and the shards' best are merged by query.

Largest inner product is searched as nearest cosine by one more component that gives all vectors of
a shard the same length; within a band lengths differ by a factor of two at most, so that component never
drowns the others. Lengths are compared by their logarithms, so no finite vector overflows. A shard's equal
vectors are one node. Layer members are the nodes whose hash falls under 1/LINKS per layer; neighbours are
chosen among a node's nearest members of the layer by the usual heuristic (a candidate stays if it is nearer
to the node than to every chosen one), filled up with the nearest others, and links are made in both
directions. A shard widens its beam from BEAM on until PROBES of its own nodes find RECALL of what an exact
search of the shard finds, so recall doesn't hang on the data.

Defined results: vectors null, zero, of no components, or holding null or non-finite components take
no part, nor do rows of null id; a query finds every other row than those of its own id; ties go to
the smaller id, at the cut too; a product that overflows is infinite, one that is no number counts as the
least; fewer candidates than k are all returned; repeated rows are candidates each, but a query repeated
with its vector is asked once, and one repeated with other vectors has a list of each. Vectors of another
length than the query's are no candidates of it.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from strandmill.llm.shared import cut

SHARD_ROWS, QUERY_ROWS, EXACT_ROWS = 16384, 4096, 1024
LINKS, BEAM, CANDIDATES = 16, 96, 48
PROBES, RECALL, NEAR = 64, 0.97, 20


class Graph:
    """A shard: distinct vectors, the ids of each, layers of (members, neighbours) from the top down."""

    def __init__(self, vectors: np.ndarray, ids: np.ndarray, offsets: np.ndarray, beam: np.ndarray, layers: list[tuple[np.ndarray, np.ndarray]]):
        self.vectors, self.ids, self.offsets, self.beam, self.layers = vectors, ids, offsets, beam, layers
        unit, log = directions(vectors)
        ratio = np.exp2(log - log.max(initial=0.0 if not len(log) else log.min()))[:, None]
        self.lifted = np.hstack([unit * ratio, np.sqrt(np.maximum(0, 1 - ratio**2))]).astype(np.float32)

    @classmethod
    def build(cls, ids: np.ndarray, vectors: np.ndarray, links: int = LINKS, candidates: int = CANDIDATES, exact: bool = False) -> Graph:
        order = np.lexsort((ids, *vectors.T[::-1]))
        ids, vectors = ids[order], vectors[order]
        new = np.ones(len(ids), bool)
        new[1:] = (vectors[1:] != vectors[:-1]).any(1)
        starts = np.flatnonzero(new)
        graph = cls(vectors[starts], ids, np.append(starts, len(ids)), np.array([len(starts)]), [])
        n = len(starts)
        if exact:
            return graph
        draw = np.array([xxhash.xxh64_intdigest(v.tobytes()) for v in graph.vectors], np.float64) / 2.0**64
        level, members = 0, np.arange(n)
        while len(members):
            width = 2 * links if level == 0 else links
            graph.layers.insert(0, (members, cls._links(graph.lifted, members, width, candidates)))
            level += 1
            upper = members[draw[members] < links ** -float(level)]
            if len(members) <= 2 * links or len(upper) == len(members):
                break
            members = upper
        graph._widen(np.argsort(draw, kind="stable")[:PROBES])
        return graph

    def _widen(self, probes: np.ndarray) -> None:
        """Sets the beam at which the probes find RECALL of their nearest nodes."""
        wanted = np.argsort(-(self.lifted[probes, :-1] @ self.lifted[:, :-1].T), axis=1, kind="stable")[:, :NEAR]
        self.beam = np.array([min(BEAM, len(self.lifted))])
        while self.beam[0] < len(self.lifted):
            found = self.search(self.vectors[probes])
            if np.mean([np.isin(w, f).mean() for w, f in zip(wanted, found)]) >= RECALL:
                break
            self.beam = np.minimum(2 * self.beam, len(self.lifted))

    @staticmethod
    def _links(x: np.ndarray, members: np.ndarray, width: int, candidates: int) -> np.ndarray:
        """Neighbours (positions in members) of each member, width a row, -1 where fewer."""
        n, m = len(members), min(candidates, len(members) - 1)
        own = x[members]
        out = np.full((n, width), -1, np.int32)
        if m <= 0:
            return out
        half = width // 2
        chosen = np.full((n, half), -1, np.int32)
        for low in range(0, n, 1024):
            rows = np.arange(low, min(n, low + 1024))
            near = own[rows] @ own.T
            near[np.arange(len(rows)), rows] = -np.inf
            best = np.argpartition(-near, m - 1, axis=1)[:, :m]
            value = np.take_along_axis(near, best, 1)
            rank = np.argsort(-value, axis=1, kind="stable")
            best, value = np.take_along_axis(best, rank, 1), np.take_along_axis(value, rank, 1)
            mutual = np.einsum("rid,rjd->rij", own[best], own[best])
            keep = np.zeros(best.shape, bool)
            for c in range(m):
                nearer = (mutual[:, c, :] > value[:, c, None]) & keep
                keep[:, c] = ~nearer.any(1) & (keep.sum(1) < half)
            place = np.where(keep, np.arange(m), np.arange(m) + m)  # chosen ones first, then the nearest others
            first = np.argsort(place, axis=1, kind="stable")[:, :half]
            chosen[rows, : first.shape[1]] = np.take_along_axis(best, first, 1)
        out[:, :half] = chosen
        # links back, nearest first, into the other half
        src = np.repeat(np.arange(n), half)
        dst = chosen.ravel()
        src, dst = src[dst >= 0], dst[dst >= 0]
        mutual = (chosen[dst] == src[:, None]).any(1)
        src, dst = src[~mutual], dst[~mutual]
        score = np.einsum("ij,ij->i", own[src], own[dst])
        order = np.lexsort((src, -score, dst))
        src, dst = src[order], dst[order]
        slot = np.arange(len(dst)) - np.searchsorted(dst, dst)
        fits = slot < width - half
        out[dst[fits], half + slot[fits]] = src[fits]
        return out

    def to_bytes(self) -> bytes:
        """Flat arrays in one buffer."""
        parts = [self.vectors, self.ids, self.offsets, self.beam, *[a for layer in self.layers for a in layer]]
        head = [len(parts)]
        for p in parts:
            head += [{"f": 0, "i": 1}[p.dtype.kind], p.dtype.itemsize, p.ndim, *p.shape, *[1] * (2 - p.ndim)]
        return np.array(head, np.int64).tobytes() + b"".join(np.ascontiguousarray(p).tobytes() for p in parts)

    @classmethod
    def from_bytes(cls, data: bytes) -> Graph:
        count = int(np.frombuffer(data, np.int64, 1)[0])
        head = np.frombuffer(data, np.int64, 1 + 5 * count)[1:].reshape(count, 5).tolist()
        at, parts = 8 * (1 + 5 * count), []
        for kind, size, dims, a, b in head:
            kind = np.dtype(f"{'fi'[kind]}{size}")
            parts.append(np.frombuffer(data, kind, a * b, at).reshape((a, b)[:dims]))
            at += a * b * size
        return cls(parts[0], parts[1], parts[2], parts[3], list(zip(parts[4::2], parts[5::2])))

    def search(self, queries: np.ndarray, beam: int = 0) -> np.ndarray:
        """The nodes of the beam (the shard's own, or a wider one) of each query, nearest first; -1 where fewer."""
        beam = max(beam, int(self.beam[0]))
        q = np.hstack([directions(queries)[0], np.zeros((len(queries), 1))]).astype(np.float32)
        entry = np.zeros((len(q), 1), np.int64)
        for k, (members, links) in enumerate(self.layers):
            place = np.searchsorted(members, entry) if k else entry
            found = _beam(self.lifted[members], links, q, place, beam if k == len(self.layers) - 1 else 4)
            entry = np.where(found >= 0, members[found], -1)
            if k < len(self.layers) - 1:
                entry = entry[:, :1]
        return entry


def directions(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Vectors of length 1 and the logarithms to base 2 of the lengths, of any finite vectors but zero."""
    if not len(vectors):
        return vectors, np.zeros(0)
    top = np.abs(vectors).max(1)
    scale, power = np.frexp(top)
    unit = np.ldexp(vectors, -power[:, None])  # components of 1 at most
    length = np.sqrt((unit**2).sum(1))
    return unit / length[:, None], np.log2(length) + power


def products(vectors: np.ndarray, query: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore", invalid="ignore"):
        value = np.einsum("ij,j->i", vectors, query)
    return np.where(np.isnan(value), -np.inf, value)


def _beam(x: np.ndarray, links: np.ndarray, q: np.ndarray, entry: np.ndarray, beam: int) -> np.ndarray:
    """Best-first search of all queries at once: each step expands every query's best unexpanded node."""
    n, width = len(q), links.shape[1]
    beam = min(beam, len(x))
    rows = np.arange(n)
    nodes = np.full((n, beam), -1, np.int64)
    score = np.full((n, beam), -np.inf, np.float32)
    done = np.ones((n, beam), bool)
    nodes[:, 0] = entry[:, 0]
    score[:, 0] = np.einsum("ij,ij->i", x[entry[:, 0]], q)
    done[:, 0] = False
    seen = np.zeros((n, len(x)), bool)
    seen[rows, entry[:, 0]] = True
    active = rows
    while len(active):
        open_score = np.where(done[active], -np.inf, score[active])
        at = open_score.argmax(1)
        go = ~done[active, at]
        active, at = active[go], at[go]
        if not len(active):
            break
        done[active, at] = True
        near = links[nodes[active, at]].astype(np.int64)
        valid = (near >= 0) & ~seen[active[:, None], near]
        seen[active[:, None], np.where(near >= 0, near, nodes[active, at][:, None])] = True
        value = np.where(valid, np.einsum("ijk,ik->ij", x[near], q[active], optimize=False), -np.inf).astype(np.float32)
        all_nodes = np.hstack([nodes[active], np.where(valid, near, -1)])
        all_score = np.hstack([score[active], value])
        all_done = np.hstack([done[active], ~valid])
        top = np.argpartition(-all_score, beam - 1, axis=1)[:, :beam]
        nodes[active] = np.take_along_axis(all_nodes, top, 1)
        score[active] = np.take_along_axis(all_score, top, 1)
        done[active] = np.take_along_axis(all_done, top, 1) | ~np.isfinite(score[active])
    order = np.argsort(-score, axis=1, kind="stable")
    return np.where(np.isfinite(np.take_along_axis(score, order, 1)), np.take_along_axis(nodes, order, 1), -1)


def best_of(graph: Graph, query_ids: np.ndarray, marks: np.ndarray, queries: np.ndarray, k: int, beam: int = 0, rows: int = 256) -> pd.DataFrame:
    """The k best rows of the shard by exact inner product for each query, its own id left out."""
    out = []
    every = np.arange(len(graph.vectors))[None]
    for low in range(0, len(query_ids), rows):
        ids, q = query_ids[low : low + rows], queries[low : low + rows]
        found = graph.search(q, max(beam, 2 * k)) if graph.layers else np.broadcast_to(every, (len(q), every.shape[1]))
        for at, own, vector, nodes in zip(range(low, low + len(ids)), ids, q, found):
            nodes = nodes[nodes >= 0]
            value = products(graph.vectors[nodes], vector)
            if len(nodes) > k + 1:  # a node may be the query's own; all that tie with the last stay
                some = value >= np.partition(value, -k - 1)[-k - 1]
                nodes, value = nodes[some], value[some]
            near, score = [], []
            for node, s in zip(nodes, value):
                same = graph.ids[graph.offsets[node] : graph.offsets[node + 1]]
                mine = np.searchsorted(same, own, "left"), np.searchsorted(same, own, "right")
                same = np.concatenate([same[: mine[0]][:k], same[mine[1] :][:k]])[:k]
                near.append(same)
                score.append(np.full(len(same), s))
            if not near:
                continue
            near, score = np.concatenate(near), np.concatenate(score)
            rank = np.lexsort((near, -score))[:k]
            out.append(pd.DataFrame({"query_id": np.full(len(rank), own, np.int64), "query": np.full(len(rank), marks[at], np.int64), "vec_id": near[rank].astype(np.int64), "score": score[rank]}))
    return pd.concat(out) if out else pd.DataFrame({c: np.array([], np.int64) for c in ("query_id", "query", "vec_id")} | {"score": np.array([], np.float64)})


def _doubles(column: pd.Series) -> np.ndarray:
    return np.stack([np.asarray(v, np.float64) for v in column]) if len(column) else np.empty((0, 0))


def usable(table: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    v = F.transform(vector_col, lambda x: x.cast("double"))
    sound = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("v", lambda x: x != 0)
    return table.select(F.col(id_col).cast("long").alias("vec_id"), v.alias("v")).where(F.col("vec_id").isNotNull() & F.col("v").isNotNull()).where(sound)


def banded(rows: DataFrame, shard_rows: int) -> DataFrame:
    """rows with band (null: pooled, searched exactly) and shard, of about shard_rows rows each."""
    top = F.array_max(F.transform("v", F.abs))
    whole = F.floor(F.log2(top))  # lengths from the largest component, scaled so that no square overflows
    part = F.when(whole < -1000, F.lit(2.0**1000)).otherwise(F.lit(1.0))
    scaled = F.transform("v", lambda x: (x * part) / (top * part))
    rows = rows.withColumn("band", F.floor(F.log2(top) + F.log2(F.aggregate(scaled, F.lit(0.0), lambda a, x: a + x * x)) / 2).cast("int"))
    sizes = rows.groupBy("dims", "band").agg(F.count(F.lit(1)).alias("n"))
    pooled = Window.partitionBy("dims")
    few = F.col("n") <= EXACT_ROWS
    sizes = sizes.withColumn("n", F.when(few, F.sum(F.when(few, F.col("n"))).over(pooled)).otherwise(F.col("n"))).select(F.col("dims").alias("d"), F.col("band").alias("b"), few.alias("few"), F.ceil(F.col("n") / shard_rows).alias("shards"))
    sizes = F.broadcast(cut(sizes)) if sizes.count() <= 100_000 else sizes
    placed = rows.join(sizes, (F.col("dims") == F.col("d")) & (F.col("band") == F.col("b")))
    return placed.withColumns({"band": F.when(~F.col("few"), F.col("band")), "shard": F.pmod(F.xxhash64("vec_id"), F.col("shards")).cast("int")}).drop("d", "b", "few", "shards")


def search(table: DataFrame, queries: DataFrame, k: int = 20, id_col: str = "vec_id", vector_col: str = "embedding", shard_rows: int = SHARD_ROWS, beam: int = 0) -> DataFrame:
    """query_id, rank, vec_id, score: each query's k nearest found among table, nearest first.

    Shards and query blocks are bounded, so a task holds one shard and one block; more of either make
    more tasks. The merge ranks k rows per query and shard."""
    rows = usable(table, id_col, vector_col).withColumn("dims", F.size("v"))
    asked = cut(usable(queries, id_col, vector_col).withColumns({"dims": F.size("v"), "query": F.xxhash64("v")}).dropDuplicates(["vec_id", "query"]))
    blocks = max(1, math.ceil(asked.count() / QUERY_ROWS))

    def build(group: pd.DataFrame) -> pd.DataFrame:
        band = group["band"].iloc[0]
        graph = Graph.build(group["vec_id"].to_numpy(np.int64), _doubles(group["v"]), exact=bool(pd.isna(band)))
        return pd.DataFrame({"band": pd.array([None if pd.isna(band) else int(band)], "Int32"), "shard": [group["shard"].iloc[0]], "dims": [group["dims"].iloc[0]], "graph": [graph.to_bytes()]})

    index = cut(banded(rows, shard_rows).groupBy("band", "shard", "dims").applyInPandas(build, "band int, shard int, dims int, graph binary"))
    place = F.concat_ws(":", F.coalesce(F.col("band").cast("string"), F.lit("few")), F.col("shard").cast("string"))
    block = F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("int")
    spread = asked.select("vec_id", "query", "v", "dims", block.alias("block")).join(index.select(F.col("dims").alias("of"), place.alias("place")), F.col("dims") == F.col("of")).drop("of")
    graphs = index.select(place.alias("place"), "dims", "graph").withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))

    def probe(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        empty = pd.DataFrame({c: np.array([], np.int64) for c in ("query_id", "query", "vec_id")} | {"score": np.array([], np.float64)})
        if not len(left) or not len(right):
            return empty
        return best_of(Graph.from_bytes(right["graph"].iloc[0]), left["vec_id"].to_numpy(np.int64), left["query"].to_numpy(np.int64), _doubles(left["v"]), k, beam)

    keys = ("place", "dims", "block")
    found = spread.groupBy(*keys).cogroup(graphs.groupBy(*keys)).applyInPandas(probe, "query_id long, query long, vec_id long, score double")
    order = Window.partitionBy("query_id", "query").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order).cast("int")).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def brute_force(ids: np.ndarray, vectors: np.ndarray, query_ids: np.ndarray, queries: np.ndarray, k: int) -> Iterator[tuple[int, list[int]]]:
    """Exact lists, for measuring recall on a fixture."""
    for own, q in zip(query_ids, queries):
        score = vectors @ q
        rank = np.lexsort((ids, -score))
        yield int(own), [int(x) for x in ids[rank] if x != own][:k]
