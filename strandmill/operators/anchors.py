"""Anchored windows of rows of any density.

An anchored window begins at its first row and takes the rows that start before anchor + width; the next
row is the next anchor. So what a run of rows does to the windows after it hangs on one number that comes in,
the place where the open window ends, and only through the first row at or beyond it: a step function with
few steps, as windows that began at different rows soon meet. Rows are dealt by ranges of (keys, place), so a
key's rows lie in as many partitions as they fill, however dense they are. One pass over the partitions gives
the step function of each partition's first run and the state after its last; the driver composes them, two
small rows a partition; a second pass, each partition from its own state, marks the windows. Both passes
hold one batch of rows at a time.
"""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from strandmill.operators.runs import settled

#: Stands for a missing place; sums with widths stay exact as doubles.
NOWHERE = -(1 << 50)
Width = Callable[[np.ndarray], np.ndarray]


@dataclass
class State:
    """Of a run after some rows: the last place, the open window's end, anchor and number, and the island's number."""

    last: int | None = None
    limit: float = -np.inf
    anchor: int = NOWHERE
    window: int = 0
    island: int = 0


def breaks(at: np.ndarray, last: int | None, widest: float) -> np.ndarray:
    """Rows that begin an island: no window can reach them."""
    new = np.empty(len(at), bool)
    new[0] = last is None or at[0] - last >= widest
    new[1:] = at[1:] - at[:-1] >= widest
    return new


def mark(at: np.ndarray, reach: np.ndarray, state: State, widest: float) -> tuple[np.ndarray, np.ndarray, np.ndarray, State]:
    """Island, window and anchor of each row, and the state after them."""
    new = breaks(at, state.last, widest)
    ends = at + reach
    place = np.arange(len(at))
    following = np.maximum(np.searchsorted(at, ends, "left"), place + 1).tolist()  # an anchor is at least its own window
    k = 0 if new[0] else int(np.searchsorted(at, state.limit, "left"))
    anchors = []
    while k < len(at):
        anchors.append(k)
        k = following[k]
    is_anchor = np.zeros(len(at), bool)
    is_anchor[anchors] = True
    number = np.cumsum(is_anchor)
    own, first = (np.maximum.accumulate(np.where(x, place, -1)) for x in (is_anchor, new))
    window = np.where(first >= 0, number - number[first] + 1, state.window + number)
    anchor = np.where(own >= 0, at[own], state.anchor)
    island = state.island + np.cumsum(new)
    limit = float(ends[own[-1]]) if own[-1] >= 0 else state.limit
    return island, window, anchor, State(int(at[-1]), limit, int(anchor[-1]), int(window[-1]), int(island[-1]))


@dataclass
class Opening:
    """A partition's first run, whose state before it is not known yet: of each step, up to which incoming window's end it
    holds, the window's end and anchor after the run, and the windows begun. An island that begins within the run makes
    all steps one: after is then the state of a run that began there."""

    widest: float
    first: int | None = None
    last: int | None = None
    uppers: np.ndarray = field(default_factory=lambda: np.array([], float))
    limits: np.ndarray = field(default_factory=lambda: np.array([], float))
    anchors: np.ndarray = field(default_factory=lambda: np.array([], np.int64))
    begun: np.ndarray = field(default_factory=lambda: np.array([], np.int64))
    after: State | None = None

    def feed(self, at: np.ndarray, reach: np.ndarray) -> None:
        if self.after is not None:
            self.after = mark(at, reach, self.after, self.widest)[3]
            return
        new = breaks(at, self.last, self.widest)
        if self.first is None:
            self.first, new[0] = int(at[0]), False  # whether the first row begins an island, the run before tells
        if new.any():
            k = int(new.argmax())
            self.after = mark(at[k:], reach[k:], State(), self.widest)[3]
            return
        last, begun = follow(at, at + reach)
        known = np.searchsorted(at, self.limits, "left")
        inside = known < len(at)
        self._enter(inside, known, at, reach, last, begun)
        # an incoming window ends before first + widest, so it ends at a row before that or at the next one
        past = self.uppers[-1] if len(self.uppers) else -np.inf
        fresh = np.flatnonzero(np.append(True, at[1:] != at[:-1]) & (at > past))
        fresh = fresh[: np.searchsorted(at[fresh], self.first + self.widest) + 1] if past < self.first + self.widest else fresh[:0]
        self.uppers = np.append(self.uppers, at[fresh])
        self.limits = np.append(self.limits, (at + reach)[last[fresh]])
        self.anchors = np.append(self.anchors, at[last[fresh]])
        self.begun = np.append(self.begun, begun[fresh])
        self._merge()
        self.last = int(at[-1])

    def _enter(self, inside: np.ndarray, known: np.ndarray, at: np.ndarray, reach: np.ndarray, last: np.ndarray, begun: np.ndarray) -> None:
        row = known[inside]
        self.limits[inside], self.anchors[inside] = (at + reach)[last[row]], at[last[row]]
        self.begun[inside] += begun[row]

    def _merge(self) -> None:
        if len(self.uppers):
            same = (self.limits[1:] == self.limits[:-1]) & (self.begun[1:] == self.begun[:-1]) & (self.anchors[1:] == self.anchors[:-1])
            keep = np.append(~same, True)
            self.uppers, self.limits, self.anchors, self.begun = (x[keep] for x in (self.uppers, self.limits, self.anchors, self.begun))

    def apply(self, state: State, islands: int) -> State:
        """The state after the run, islands of which begin within it, from the state before it."""
        if state.last is None or self.first - state.last >= self.widest:
            state = State(state.last, -np.inf, NOWHERE, 0, state.island + 1)
        if self.after is not None:
            return State(self.after.last, self.after.limit, self.after.anchor, self.after.window, state.island + islands)
        step = int(np.searchsorted(self.uppers, state.limit, "left"))
        if step == len(self.uppers):
            return State(self.last, state.limit, state.anchor, state.window, state.island)
        return State(self.last, float(self.limits[step]), int(self.anchors[step]), state.window + int(self.begun[step]), state.island)


def follow(at: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of each row as an anchor, the last anchor of the rows and how many there are, by doubling."""
    n = len(at)
    jump = np.append(np.maximum(np.searchsorted(at, ends, "left"), np.arange(1, n + 1)), n)
    last, count = np.append(np.arange(n), -1), np.append(np.ones(n, np.int64), 0)
    while (jump < n).any():
        on = jump < n
        last = np.where(on, last[jump], last)
        count = count + np.where(on, count[jump], 0)
        jump = jump[jump]
    return last[:-1], count[:-1]


def segments(batch: pa.RecordBatch, keys: int, before: tuple | None) -> list[tuple[int, int, bool]]:
    """Runs of one key in a batch, whose first columns are the keys: from, to, whether another key stood before."""
    n = batch.num_rows
    new = np.zeros(n, bool)
    for k in range(keys):
        column = batch.column(k)
        a, b = column.slice(1), column.slice(0, n - 1)
        differs = pc.and_not(pc.fill_null(pc.not_equal(a, b), True), pc.and_(pc.is_null(a), pc.is_null(b)))
        new[1:] |= differs.to_numpy(zero_copy_only=False)
    new[0] = before is None or before != key_at(batch, keys, 0)
    starts = np.flatnonzero(new)
    cuts = sorted({0, *starts.tolist(), n})
    return [(a, b, bool(new[a])) for a, b in zip(cuts, cuts[1:])]


def key_at(batch: pa.RecordBatch, keys: int, row: int) -> tuple:
    return tuple(batch.column(k)[row].as_py() for k in range(keys))


def _openings(keys: int, width: Width, widest: float) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Of each partition: its first run's key and step function, and its last run's key and state if that is another run."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        opening, state, key, runs, inner = Opening(widest), State(), None, 0, 0
        first = None
        for batch in batches:
            if not batch.num_rows:
                continue
            at, reach = batch.column(keys).to_numpy(), width(batch.column(keys + 1).to_numpy(zero_copy_only=False))
            for a, b, new in segments(batch, keys, key):
                if new:
                    runs, state = runs + 1, State()
                    first = key_at(batch, keys, a) if runs == 1 else first
                if runs == 1:
                    inner += int(breaks(at[a:b], opening.last if opening.after is None else opening.after.last, widest).sum()) - (opening.first is None)
                    opening.feed(at[a:b], reach[a:b])
                else:
                    state = mark(at[a:b], reach[a:b], state, widest)[3]
            key = key_at(batch, keys, batch.num_rows - 1)
        if runs:
            told = pickle.dumps((first, opening, inner, key if runs > 1 else None, state if runs > 1 else None))
            yield pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId()], pa.int64()), pa.array([told], pa.binary())], names=["partition", "told"])

    return run


def _states(rows: list) -> dict[int, State]:
    """The state before each partition's first run."""
    out: dict[int, State] = {}
    key, state = None, State()
    for partition, told in sorted((r["partition"], bytes(r["told"])) for r in rows):
        first, opening, inner, last, after = pickle.loads(told)
        out[partition] = state if first == key else State()
        key, state = (first, opening.apply(out[partition], inner)) if last is None else (last, after)
    return out


def anchored(df: DataFrame, keys: list[str], order: list[str], width: Width, widest: float, start: str = "start", size: str = "sv_len") -> DataFrame:
    """df with island (runs that no window of the widest width bridges, from 1 within keys), window (from 1 within the island)
    and anchor (the start of the window's first row). width: of each anchor's size, widest at most.

    Defined results: rows without a start stand first, in an island of their own without anchor; null keys are a key;
    rows equal in start and order have no fixed order among them; an empty table stays empty."""
    place = F.coalesce(F.col(start).cast("long"), F.lit(NOWHERE))
    ahead = [F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)]
    wide = df.select(*ahead, place.alias("__at"), F.col(size).alias("__size"), *df.columns)
    by = [*[f"__k{i}" for i in range(len(keys))], "__at", *order]
    dealt = settled(wide.repartitionByRange(*by).sortWithinPartitions(*by))
    n = len(keys)
    states = _states(dealt.select(*dealt.columns[: n + 2]).mapInArrow(_openings(n, width, widest), "partition long, told binary").collect())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state = None, states.get(TaskContext.get().partitionId(), State())
        for batch in batches:
            if not batch.num_rows:
                continue
            at, reach = batch.column(n).to_numpy(), width(batch.column(n + 1).to_numpy(zero_copy_only=False))
            out = [np.empty(len(at), np.int64) for _ in range(3)]
            for a, b, new in segments(batch, n, key):
                if new and (key is not None or a):
                    state = State()
                *found, state = mark(at[a:b], reach[a:b], state, widest)
                for column, values in zip(out, found):
                    column[a:b] = values
            key = key_at(batch, n, batch.num_rows - 1)
            marks = [pa.array(out[0]), pa.array(out[1]), pa.array(out[2], mask=out[2] == NOWHERE)]
            yield pa.RecordBatch.from_arrays([*batch.columns[n + 2 :], *marks], names=[*batch.schema.names[n + 2 :], "island", "window", "anchor"])

    schema = StructType([*df.schema.fields, *[StructField(c, LongType()) for c in ("island", "window", "anchor")]])
    return dealt.mapInArrow(run, schema)
