"""The smaller side of an interval join is cut finer, so that the larger one is not copied to coarse levels."""

import random

from strandmill.operators import intervals


def test_fewer_intervals_meet_in_finer_bins(spark, monkeypatch):
    draw = random.Random(9)
    schema = "chrom string, start long, stop long, k long"

    def made(n, sizes):
        starts = [draw.randrange(-30_000, 90_000) for _ in range(n)]
        return [(draw.choice("ab"), s, s + draw.choice(sizes), k) for k, s in enumerate(starts)]

    many, few = made(600, [-3, 0, 40, 1000]), made(90, [-1, 0, 150, 3000, 2047, 2048, 9000, 17000, 200_000])
    left, right = spark.createDataFrame(many, schema), spark.createDataFrame(few, schema)
    want = sorted((x[3], y[3]) for x in many for y in few if x[0] == y[0] and x[1] <= y[2] and x[2] >= y[1] and x[1] <= x[2] and y[1] <= y[2])
    monkeypatch.setattr(intervals, "SMALL", 5)
    copies = []
    keyed = intervals._keyed
    monkeypatch.setattr(intervals, "_keyed", lambda df, start, stop, side, *rest: (copies.append((side, keyed(df, start, stop, side, *rest).count())), keyed(df, start, stop, side, *rest))[1])
    for fewer in (4, 1000):
        monkeypatch.setattr(intervals, "FEWER", fewer)
        assert sorted(map(tuple, intervals.overlap_join(left, right).select("k", "r_k").collect())) == want
        assert sorted((b, a) for a, b in map(tuple, intervals.overlap_join(right, left).select("k", "r_k").collect())) == want
    found = [n for side, n in copies]
    assert found[1] < found[5]  # of the many rows on the left, with finer bins and without
