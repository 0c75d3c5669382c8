"""Look-back clustering: each row joins the cluster of the nearest earlier row of its window that is like it.

Earlier like rows are found by an index, for all windows of a frame at once. Two rows are alike only if their lengths'
logarithms are closer than one bucket and their starts, or stops, closer than one cell, so an earlier like row
lies in a bucket and cell next to the row's own. In each of these the rows are listed in order, and a row walks
back from its own place until one is like it, or no nearer than what it has found elsewhere. Clusters are the
roots of the trees that this makes, found by pointer jumping.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

from strandmill.functions.scalars import TOLERANCES
from strandmill.operators.runs import map_runs, schema_with


def tolerances(size: np.ndarray, name: str) -> np.ndarray:
    out = np.full(len(size), np.nan)
    for upper, base, slope, off, up in reversed(TOLERANCES[name]):
        part = slope * (size - off)
        value = base + (np.ceil(part) if up else part)
        out = value if upper is None else np.where(size <= upper, value, out)
    return out


class Cells:
    """Rows by window, length bucket and cell: in each the rows in order."""

    def __init__(self, window: np.ndarray, bucket: np.ndarray, cell: np.ndarray):
        self.base = [int(x.min(initial=0)) - 1 for x in (window, bucket, cell)]
        self.span = [int(x.max(initial=0)) - b + 2 for x, b in zip((window, bucket, cell), self.base)]
        if math.prod(self.span) >= 1 << 62:  # too far apart for one number: cells are numbered in order, gaps shortened
            values = np.unique(np.concatenate([cell - 1, cell, cell + 1]))
            self.values: np.ndarray | None = values
            cell = np.searchsorted(values, cell)
            self.base[2], self.span[2] = -1, len(values) + 2
        else:
            self.values = None
        key = self._key(window, bucket, cell)
        self.rows = np.argsort(key, kind="stable")
        self.keys = key[self.rows]

    def _key(self, window: np.ndarray, bucket: np.ndarray, cell: np.ndarray) -> np.ndarray:
        (w, b, c), (_, nb, nc) = self.base, self.span
        return ((window - w) * nb + (bucket - b)) * nc + (cell - c)

    def before(self, row: np.ndarray, window: np.ndarray, bucket: np.ndarray, cell: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of each row, where in rows the list of the cell begins, and where its last row before this one stands (before the
        beginning, if there is none)."""
        if self.values is not None:
            cell = np.searchsorted(self.values, cell)
        key = self._key(window, bucket, cell)
        first, stop = np.searchsorted(self.keys, key, "left"), np.searchsorted(self.keys, key, "right")
        low, high = first.copy(), stop
        while (open_ := low < high).any():  # binary search of the row's number in its list
            middle = (low + high) // 2
            less = open_ & (self.rows[np.minimum(middle, len(self.rows) - 1)] < row)
            low, high = np.where(less, middle + 1, low), np.where(open_ & ~less, middle, high)
        return first, low - 1


def parents(window: np.ndarray, start: np.ndarray, stop: np.ndarray, size: np.ndarray, reach: np.ndarray, fold: float, back: np.ndarray) -> np.ndarray:
    """Index of each row's nearest earlier like row of its window within back rows, or its own. Rows are in order, windows
    numbered; like: the shorter length over the longer above fold, and start or stop at most the earlier row's reach away.
    Lengths of 0 or less are like none."""
    n = len(start)
    every = np.arange(n)
    best = np.full(n, -1)
    usable = np.flatnonzero(size > 0)
    if not len(usable):
        return every
    with np.errstate(divide="ignore"):
        bucket = np.floor(np.log(np.where(size > 0, size, 1.0)) / -math.log(fold)).astype(np.int64)
    width = max(1, int(math.ceil(reach[usable].max())))
    lowest = np.maximum(np.searchsorted(window, window, "left"), every - back)
    for place, cells in ((start, (0, -1)), (stop, (0, -1, 1))):
        cell = place // width
        index = Cells(window[usable], bucket[usable], cell[usable])
        for db in (0, -1, 1):
            for dc in cells:
                first, at = index.before(np.arange(len(usable)), window[usable], bucket[usable] + db, cell[usable] + dc)
                rows = usable
                while True:
                    other = usable[index.rows[np.maximum(at, 0)]]
                    go = (at >= first) & (other > best[rows]) & (other >= lowest[rows])
                    rows, at, first, other = rows[go], at[go], first[go], other[go]
                    if not len(rows):
                        break
                    ratio = np.minimum(size[other] / size[rows], size[rows] / size[other])
                    like = (ratio > fold) & ((np.abs(start[other] - start[rows]) <= reach[other]) | (np.abs(stop[other] - stop[rows]) <= reach[other]))
                    best[rows[like]] = other[like]
                    rows, at, first = rows[~like], at[~like] - 1, first[~like]
    return np.where(best >= 0, best, every)


def numbered(parent: np.ndarray, window: np.ndarray) -> np.ndarray:
    """Cluster of each row, named by its first row's index in its window; -1 for rows alone."""
    root = parent
    while (further := root[root] != root).any():
        root = np.where(further, root[root], root)
    alone = np.bincount(root, minlength=len(root))[root] == 1
    return np.where(alone, -1, root - np.searchsorted(window, window, "left"))


def look_back(windows: DataFrame, keys: list[str], order: list[str], tolerance: str, fold: float = 0.8, share: float = 0.8) -> DataFrame:
    """Adds cluster: the index, from 0 in the window, of the cluster's first row, or -1. A row looks back
    over share of its window's rows. keys name the window."""

    def work(rows: pd.DataFrame) -> pd.DataFrame:
        window = rows["__run"].to_numpy()
        size = rows["sv_len"].to_numpy(float)
        many = np.searchsorted(window, window, "right") - np.searchsorted(window, window, "left")
        p = parents(window, rows["start"].to_numpy(), rows["stop"].to_numpy(), size, tolerances(size, tolerance), fold, np.ceil(share * many).astype(np.int64))
        return rows.drop(columns="__run").assign(cluster=numbered(p, window))

    return map_runs(windows, keys, ["start", *order], work, schema_with(windows, cluster="long"))


def pair_parents(window: np.ndarray, a: np.ndarray, b: np.ndarray, reach: int, back: int) -> np.ndarray:
    """Index of each row's nearest of the back rows before it, in its window, of which both places are within reach; or its own."""
    out = np.arange(len(a))
    rows = out
    for step in range(1, back + 1):
        rows = rows[rows >= step]
        rows = rows[window[rows - step] == window[rows]]
        if not len(rows):
            break
        like = (np.abs(a[rows] - a[rows - step]) <= reach) & (np.abs(b[rows] - b[rows - step]) <= reach)
        out[rows[like]] = rows[like] - step
        rows = rows[~like]
    return out


def look_back_pairs(windows: DataFrame, keys: list[str], order: list[str], reach: int = 1000, back: int = 40) -> DataFrame:
    """Translocations: both positions within reach of one of the last back rows."""

    def work(rows: pd.DataFrame) -> pd.DataFrame:
        window = rows["__run"].to_numpy()
        p = pair_parents(window, rows["start"].to_numpy(), rows["start2"].to_numpy(), reach, back)
        return rows.drop(columns="__run").assign(cluster=numbered(p, window))

    return map_runs(windows, keys, ["start", "start2", *order], work, schema_with(windows, cluster="long"))
