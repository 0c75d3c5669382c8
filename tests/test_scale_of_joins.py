"""Steps that grow with the input alone: interval joins without broadcasts, counts without pairs, pairs without copies."""

import random

import pytest

from strandmill.operators import alignments, intervals, markers

SCHEMA = "k long, chrom string, start long, stop long"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def made(n, seed, lengths):
    random.seed(seed)
    places = lambda: random.choice([random.randrange(300), random.randrange(200_000), 65536 * random.randrange(4) + random.randrange(-2, 3)])
    return [(k, random.choice(["a", "b", None]), a, a + random.choice(lengths)) for k, a in enumerate(places() for _ in range(n))]


def overlaps(a, b):
    return a[1] is not None and a[1] == b[1] and a[2] <= a[3] and b[2] <= b[3] and a[2] <= b[3] and a[3] >= b[2]


@pytest.mark.parametrize("left, right", [([-1, 0, 5, 300], [0, 3, 100, 5000]), ([0, 2000, 2047, 2048, 70000, 20_000_000], [-1, 0, 5, 16384, 300_000])])
def test_joins_and_counts_equal_all_pairs(spark, monkeypatch, left, right):
    monkeypatch.setattr(intervals, "SMALL", 0)
    a, b = made(90, 1, left), made(110, 2, right)
    one, two = spark.createDataFrame(a, SCHEMA), spark.createDataFrame(b, SCHEMA)
    assert sorted(tuple(r) for r in intervals.overlap_join(one, two).select("k", "r_k").collect()) == sorted((x[0], y[0]) for x in a for y in b if overlaps(x, y))
    sizes = intervals.left_levels(one, "start", "stop")
    assert intervals.overlap_join(one, two, sizes=sizes).count() == sum(overlaps(x, y) for x in a for y in b)
    counts = {r["k"]: r["n"] for r in intervals.count_overlaps(one, two, ["k"]).collect()}
    assert counts == {x[0]: sum(overlaps(x, y) for y in b) for x in a}
    counts = {r["k"]: r["n"] for r in intervals.count_covering(one, two, ["k"]).collect()}
    assert counts == {x[0]: sum(overlaps(x, y) and y[2] <= x[2] and y[3] >= x[3] for y in b) for x in a}


def test_only_counted_sides_are_broadcast(spark, monkeypatch):
    rows = spark.range(50).selectExpr("id as k", "'a' as chrom", "id * 10 as start", "id * 10 + 5 as stop")
    monkeypatch.setattr(intervals, "SMALL", 49)
    assert "BroadcastHashJoin" not in plan(intervals.overlap_join(rows, rows))
    monkeypatch.setattr(intervals, "SMALL", 50)
    assert "BroadcastHashJoin" in plan(intervals.overlap_join(rows, rows))


def test_rows_are_keyed_where_others_are(spark):
    rows = spark.createDataFrame([(1, "a", 100, 150)], SCHEMA)
    assert intervals._keyed(rows, "start", "stop", "l", {11: 1}, {11: 1}).count() == 1
    assert intervals._keyed(rows, "start", "stop", "r", {11: 1}, {11: 1}).count() == 1


def test_counts_make_no_pairs(spark):
    near = spark.range(3000).selectExpr("id as k", "'a' as chrom", "id % 7 as start", "id % 7 + 9 as stop")
    for count in (intervals.count_overlaps, intervals.count_covering):
        counted = count(near, near.selectExpr("chrom", "start", "stop + 900 as stop"), ["k"])
        assert "bin" not in plan(counted)
        assert {r["n"] for r in counted.where("k % 7 = 6").collect()} == {3000}


def test_contigs_of_few_pieces_move_once(spark, monkeypatch):
    pieces = [(f"q{k % 40}", 0 if k < 40 else 2048, f"Chr{k % 3 + 1}", 100 * k % 5000, 100 * k % 5000 + 400, (37 * k % 900, 400, 11 * k % 900), 60) for k in range(400)]
    segs = spark.createDataFrame(pieces + pieces[:90], "qname string, flag int, chrom string, start long, stop long, clip struct<left:long,mapped:long,right:long>, mapq int")
    few = alignments.banded_pairs(segs)
    assert "Generate" not in plan(few)
    found = sorted(map(str, few.collect()))
    monkeypatch.setattr(alignments, "FEW", 0)
    assert sorted(map(str, alignments.banded_pairs(segs).collect())) == found and found
    both = alignments.banded_pairs(segs, kind="same").unionByName(alignments.banded_pairs(segs, kind="other"))
    assert sorted(map(str, both.collect())) == found


def test_primers_leave_a_few_at_a_time(spark, monkeypatch):
    random.seed(5)
    rows = [(str(k), "".join(random.choice("ACGT") for _ in range(700)), 60) for k in range(12)] + [("short", "ACG", 60), ("none", None, 60)]
    table = spark.createDataFrame(rows, "id string, seq string, sv_size long").coalesce(1)
    sizes = []
    frame = markers.pd.DataFrame
    monkeypatch.setattr(markers, "PRIMERS", 50)
    held = {}
    monkeypatch.setattr(type(table), "mapInPandas", lambda self, run, schema: held.update(run=run, rows=self) or self)
    markers.primer_candidates(table, flank=120)
    parts = list(held["run"](iter([held["rows"].toPandas()])))
    assert len(parts) > 2 and isinstance(parts[0], frame)
    sizes = [len(p) for p in parts]
    whole = markers.pd.concat(parts)
    assert max(sizes) < 50 + whole.groupby("id").size().max()
    seqs = {i: s for i, s, _ in rows}
    for r in whole.itertuples():
        own = r.primer if r.side == "forward" else r.primer.translate(str.maketrans("ACGT", "TGCA"))[::-1]
        at = r.pos if r.side == "forward" else r.pos - len(own) + 1
        assert seqs[r.id][at : at + len(own)] == own
