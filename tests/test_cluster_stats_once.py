"""Statistics of clusters take their rows once."""

import random
from collections import Counter

import numpy as np
import pytest

from strandmill.operators import clusters


@pytest.mark.parametrize("median_stop", [False, True])
def test_cluster_stats_move_rows_once(spark, median_stop):
    draw = random.Random(3)
    rows = [(f"q{draw.randrange(9)}", draw.randrange(20), draw.randrange(40), draw.randrange(8), draw.randrange(60), draw.choice([1, 2, 3, None])) for _ in range(200)]
    table = spark.createDataFrame([(*r[:5], r[5]) for r in rows], "query_name string, start long, stop long, sv_len long, maq int, cluster long")
    found = clusters.cluster_stats(table, ["cluster"], median_stop)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "Join" not in plan

    def mode(values):
        low, high = np.percentile(values, [25, 75])
        counts = Counter([v for v in values if low <= v <= high] or values)
        return max(counts, key=lambda v: (counts[v], -v))

    want = {}
    for c in (1, 2, 3):
        own = [r for r in rows if r[5] == c]
        stop = mode([r[2] for r in own]) if median_stop else max(r[2] for r in own)
        want[c] = (mode([r[1] for r in own]), stop, mode([r[3] for r in own]), mode([r[4] for r in own]), sorted({r[0] for r in own}))
    got = {r["cluster"]: (r["start"], r["stop"], r["sv_len"], r["maq"], r["reads_id"]) for r in found.collect()}
    assert got == want and all(r["reads"] == len(r["reads_id"]) for r in found.collect())
