"""Pairs of several templates are worked out in one call, and templates without pairs are not taken."""

import random

from strandmill.operators import markers


def test_pairs_of_templates_are_worked_out_together(spark):
    draw = random.Random(5)
    rows = [(str(k), "".join(draw.choice("ACGT") for _ in range(n)), 60) for k, n in enumerate((50, 150, 170, 240, 700, 1500, 1600, 1660, 1704, 1705, 1730, 1800, 5000))]
    table = spark.createDataFrame(rows, "id string, seq string, sv_size long")
    some = markers.pairable(table, flank=120)
    assert {len(r["seq"]) for r in some.collect()} == {170, 240, 700, 1500, 1600, 1660, 1704}
    best = lambda t: markers.best_primers(markers.primer_candidates(t, flank=120), t)
    found = best(some)
    assert "FlatMapGroupsInPandas" not in found._jdf.queryExecution().executedPlan().toString()
    got = sorted(map(tuple, found.collect()))
    assert got and got == sorted(map(tuple, best(table).collect()))
    one = [tuple(r) for k in sorted(r["id"] for r in some.collect())[:3] for r in best(table.where(f"id = '{k}'")).collect()]
    assert set(one) <= set(got)
