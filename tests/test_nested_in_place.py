"""Nested pairs are made where their islands lie."""

import random

import pytest

from strandmill.operators import nested, runs, windows


@pytest.mark.parametrize("near", [0, 100])
@pytest.mark.parametrize("few", [64, 3])
def test_nested_pairs_in_lists_and_by_joins(spark, monkeypatch, near, few):
    draw = random.Random(5)
    kinds = ["DUP", "INV", "DEL", "INS"]
    rows = []
    for k in range(300):
        start = draw.randrange(0, 12000)
        rows.append((draw.choice(["a", "b", None]), start, start + draw.randrange(-2, 700), draw.randrange(30, 700), draw.choice(kinds), k))
    table = spark.createDataFrame(rows, "chrom string, start long, stop long, sv_len long, sv_type string, k long")
    want, island = set(), {}
    for chrom in "ab":
        last, number = None, 0
        for r in sorted((r for r in rows if r[0] == chrom), key=lambda r: (r[1], r[3], r[5])):
            number += last is None or r[1] > last + 20
            island[r[5]], last = number, r[2]
    for o in rows:
        for i in rows:
            inside = o[1] - near <= i[1] and o[2] + near >= i[2] and o[1] - near <= o[2] + near and i[1] <= i[2]
            if o[0] and o[0] == i[0] and island[o[5]] == island[i[5]] and o[5] != i[5] and inside and (o[4], i[4]) in nested.ALLOWED["near"] and (not near or o[3] > i[3]):
                want.add((o[0], island[o[5]], o[5], i[5]))
    monkeypatch.setattr(nested, "FEW", few)
    for plain in (10_000, 0):
        numbered = runs.numbered_islands
        monkeypatch.setattr(nested, "numbered_islands", lambda *a, plain=plain: numbered(*a, stretch=9, plain=plain))
        pairs = nested.nested_pairs(table, ["sv_len", "k"], "near", 20, near)
        found = [(r["chrom"], r["cluster"], r["o_k"], r["i_k"]) for r in pairs.collect()]
        assert len(found) == len(set(found)) and set(found) == want and len(want) > 20


def test_pairs_of_small_clusters_are_not_joined_row_by_row(spark):
    table = spark.createDataFrame([("a", 0, 500, 500, "DUP", 1), ("a", 10, 60, 50, "DEL", 2)], "chrom string, start long, stop long, sv_len long, sv_type string, k long")
    pairs = nested.nested_pairs(table, ["sv_len", "k"], "genome", 500)
    assert "collect_list" in pairs._jdf.queryExecution().optimizedPlan().toString()
    assert [(r["o_k"], r["i_k"]) for r in pairs.collect()] == [(1, 2)]
    assert windows.nested_gaps(table, ["chrom"], ["sv_len", "k"]).columns == [*table.columns, "island"]
