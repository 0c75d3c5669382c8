"""The cohort merge as a stream: candidates of samples come as files, and a window's merged candidates go out once it is closed.

State is kept by window of arrival, chromosome, type and stretch of places: the candidates seen, equal ones counted. When the
watermark passes the window's end, each stretch gives the clusters that lie wholly inside it, merged, and the rows of
its first and last cluster as they are, which may go on in the next stretch; these few are merged in the batch that
writes the result. The table then equals the merge of all the window's files at once.

Defined results: rows later than the watermark allows are left out; rows without a place or time take no part; a window is
written once; a cluster of rows of one stretch and of many gives the same row.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from strandmill.operators.runs import islands

STRETCH = 20
#: Of a candidate what the merge reads; n: how many equal ones.
VALUES = ["start", "stop", "sv_len", "maq", "n"]
STATE = ", ".join(f"{v} array<long>" for v in VALUES) + ", ends long"
OUT = "window_start timestamp, chrom string, sv_type string, stretch long, run long, edge boolean, start long, stop long, sv_len long, maq long, n long"


def runs_of(rows: pd.DataFrame, shift: int, ratio: tuple[float, float]) -> np.ndarray:
    """Number of the run of each row, in order: a row near its predecessor in start, stop and length goes on with its run."""
    start, stop, size = (rows[c].to_numpy(np.float64) for c in ("start", "stop", "sv_len"))
    with np.errstate(divide="ignore", invalid="ignore"):
        share = size[:-1] / size[1:]
    near = (np.abs(np.diff(start)) <= shift) & (np.abs(np.diff(stop)) <= shift) & (share > ratio[0]) & (share < ratio[1])
    return np.append(0, np.cumsum(~near)) if len(rows) else np.array([], int)


def counted(rows: pd.DataFrame) -> pd.DataFrame:
    return rows.groupby(VALUES[:-1], as_index=False, sort=True)["n"].sum()


def most_frequent(values: np.ndarray, n: np.ndarray) -> int:
    """The value of most rows, the smallest of equal ones."""
    distinct, back = np.unique(values, return_inverse=True)
    return int(distinct[np.bincount(back, n).argmax()])


def merged_stream(stream: DataFrame, late: str = "1 hour", window: str = "1 day", shift: int = 100, ratio: tuple[float, float] = (0.8, 1.2), stretch: int = STRETCH) -> DataFrame:
    """stream: chrom, sv_type, start, stop, sv_len, maq, seen (a timestamp). Rows of OUT: merged clusters, and the rows at the edges of stretches."""

    def step(key: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        known = pd.DataFrame(dict(zip(VALUES, state.get[:-1]))) if state.exists else pd.DataFrame({v: np.array([], np.int64) for v in VALUES})
        ends = state.get[-1] if state.exists else None
        if not state.hasTimedOut:
            for part in parts:
                ends = int(part["ends"].iloc[0])
                known = counted(pd.concat([known, part[VALUES].astype(np.int64)]))
            state.update((*[known[v].tolist() for v in VALUES], ends))
            state.setTimeoutTimestamp(max(ends, state.getCurrentWatermarkMs() + 1))
            return
        state.remove()
        known = known.sort_values(VALUES[:-1], kind="stable").reset_index(drop=True)
        run = runs_of(known, shift, ratio)
        last = int(run[-1]) if len(run) else -1
        rows = []
        for k in range(last + 1):
            own = known[run == k]
            n = own["n"].to_numpy()
            if k in (0, last):
                rows += [(k, True, *r) for r in own[VALUES].itertuples(index=False)]
            else:
                mean = int((own["maq"] * own["n"]).sum() // n.sum())
                rows.append((k, False, *(most_frequent(own[c].to_numpy(), n) for c in ("start", "stop", "sv_len")), mean, int(n.sum())))
        out = pd.DataFrame(rows, columns=["run", "edge", *VALUES])
        for name, value in zip(("stretch", "sv_type", "chrom", "window_start"), key[::-1]):
            out.insert(0, name, value)
        yield out

    timed = stream.where("start is not null and seen is not null").withWatermark("seen", late)
    own = F.window("seen", window)
    rows = timed.select(
        own["start"].alias("window_start"), F.unix_millis(own["end"]).alias("ends"), "seen", "chrom", "sv_type", F.shiftright("start", stretch).alias("stretch"),
        *[F.col(v).cast("long").alias(v) for v in VALUES[:-1]], F.lit(1).cast("long").alias("n"))
    keys = ["window_start", "chrom", "sv_type", "stretch"]
    return rows.groupBy(*keys).applyInPandasWithState(step, OUT, STATE, "append", GroupStateTimeout.EventTimeTimeout)


def joined_edges(rows: DataFrame, shift: int = 100, ratio: tuple[float, float] = (0.8, 1.2)) -> DataFrame:
    """Rows of OUT of closed windows as merged candidates: window_start, chrom, sv_type, start, stop, sv_len, maq, merged."""
    keys = ["window_start", "chrom", "sv_type"]

    def apart(prev: Callable[[str], Column]) -> Column:
        share = F.try_divide(prev("sv_len"), F.col("sv_len"))
        near = (F.abs(F.col("start") - prev("start")) <= shift) & (F.abs(F.col("stop") - prev("stop")) <= shift) & (share > ratio[0]) & (share < ratio[1])
        return ~near | ((F.col("stretch") == prev("stretch")) & (F.col("run") != prev("run")))

    numbered = islands(rows.where("edge"), keys, ["start", "stop", "sv_len", "maq"], apart)
    each = numbered.withColumn("one", F.explode(F.sequence(F.lit(1).cast("long"), F.col("n"))))
    whole = each.groupBy(*keys, "island").agg(*[F.mode(c, True).alias(c) for c in ("start", "stop", "sv_len")], F.floor(F.avg("maq")).cast("int").alias("maq"), F.count(F.lit(1)).alias("merged"))
    inner = rows.where("not edge").select(*keys, "start", "stop", "sv_len", F.col("maq").cast("int").alias("maq"), F.col("n").alias("merged"))
    return whole.drop("island").unionByName(inner)


def merge_into(stream: DataFrame, table: str, checkpoint: str, late: str = "1 hour", window: str = "1 day", shift: int = 100, stretch: int = STRETCH) -> StreamingQuery:
    """Writes the merged candidates of each closed window to the table (Parquet, a folder a batch): a batch that is tried again
    overwrites what it has written."""

    def write(batch: DataFrame, number: int) -> None:
        batch.persist()
        joined_edges(batch, shift).write.mode("overwrite").parquet(f"{table}/batch={number}")
        batch.unpersist()

    return merged_stream(stream, late, window, shift, stretch=stretch).writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()
