"""Counts of intervals without pairs, in which rows move once."""

from strandmill.operators import intervals


def _tables(spark, far):
    edge = 1 << intervals.STRETCH
    places = [(k, k + w) for k in (0, 10, edge - 5000, edge - 3, edge - 1, edge, edge + 1, edge + intervals.REACH, 3 * edge - 2, 9 * edge) for w in (0, 1, 2, 7, 900, intervals.REACH)]
    places += [(edge - 10, edge + intervals.REACH + 1), (5, 4 * edge)] if far else []
    left = [(f"v{i}", c, a, b) for i, (a, b) in enumerate(places) for c in ("a", "b")] + [("x", None, 5, 9), ("y", "a", 9, 5), ("z", "a", None, 5)]
    right = [("a", k * 611, k * 611 + (k * 37) % 5000) for k in range(-20, 900)] + [("a", 7, 3), (None, 1, 9), ("a", 0, 9 * edge), ("b", edge, edge), ("b", edge + intervals.REACH, edge + intervals.REACH)]
    return left, right, spark.createDataFrame([(c + v if c else v, c, a, b) for v, c, a, b in left], "id string, chrom string, start long, stop long"), spark.createDataFrame(right, "chrom string, start long, stop long")


def _known(row):
    return None not in row[1:] and row[2] <= row[3]


def test_counts_at_edges_of_stretches_equal_pairs(spark):
    for far in (False, True):
        left, right, l, r = _tables(spark, far)
        own = lambda v, c: (c or "") + v
        good = [x for x in right if x[0] and x[1] <= x[2]]
        over = {own(v, c): sum(_known((v, c, a, b)) and g[0] == c and g[1] <= b and g[2] >= a for g in good) for v, c, a, b in left}
        cover = {own(v, c): sum(_known((v, c, a, b)) and g[0] == c and g[1] <= a and g[2] >= b for g in good) for v, c, a, b in left}
        assert {x["id"]: x["n"] for x in intervals.count_overlaps(l, r, ["id"]).collect()} == over
        assert {x["id"]: x["n"] for x in intervals.count_covering(l, r, ["id"]).collect()} == cover


def test_counted_rows_are_not_joined_again(spark):
    _, _, l, r = _tables(spark, False)
    counted = intervals.count_overlaps(l, r, ["id"])
    assert "Join" not in counted._jdf.queryExecution().optimizedPlan().toString()
