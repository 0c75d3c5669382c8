"""Operators on small tables: boundaries, brute force, properties."""

import math
import random

import pytest
from pyspark.sql import functions as F

from strandmill.functions import scalars
from strandmill.operators import alignments, annotation, clusters, cohort, filters, genotypes, intervals, lookback, markers, nested, runs, windows

SIG = "chrom string, sv_type string, query_name string, start long, stop long, sv_len long, maq int, svid string, seq string, k long"


def signals(spark, n=300, seed=1, types=("DEL", "INS")):
    draw = random.Random(seed)
    rows = []
    for k in range(n):
        start, size = draw.randrange(0, 30000), draw.choice([40, 80, 99, 100, 101, 300, 500, 501, 900, 1000, 1001, 4999, 5000, 5001])
        rows.append((f"c{draw.randrange(2)}", draw.choice(types), f"r{draw.randrange(60)}", start, start + size - 1, size, draw.randrange(20, 61), f"id{k}", "*", k))
    return spark.createDataFrame(rows, SIG), rows


def width(size):
    return 200 + 0.5 * size if size < 100 else 400 + 0.5 * size if 100 < size <= 500 else 600 + 0.5 * size if 500 < size <= 1000 else 1500


def test_adaptive_windows_equal_a_sequential_fold(spark):
    df, rows = signals(spark)
    got = {r["k"]: r["anchor"] for r in windows.adaptive_windows(df, ["chrom", "sv_type"], ["sv_len", "k"]).collect()}
    want = {}
    for key in {(r[0], r[1]) for r in rows}:
        anchor = limit = None
        for r in sorted((r for r in rows if (r[0], r[1]) == key), key=lambda r: (r[3], r[5], r[9])):
            if limit is None or r[3] >= limit:
                anchor, limit = r[3], r[3] + width(r[5])
            want[r[9]] = anchor
    assert got == want


@pytest.mark.parametrize("stretch", [3, 12, 40])
def test_islands_do_not_depend_on_stretches(spark, stretch):
    df, rows = signals(spark, 400, 5)
    nulls = spark.createDataFrame([(None, "DEL", "r", 5, 9, 40, 30, "a", "*", 1000), (None, "DEL", "r", 7, 9, 40, 30, "a", "*", 1001), (None, "DEL", "r", 9000, 9, 40, 30, "a", "*", 1002), (None, "DEL", "r", None, 9, 40, 30, "a", "*", 1003)], SIG)
    found = runs.islands(df.union(nulls), ["chrom", "sv_type"], ["start", "sv_len", "k"], lambda prev: F.col("start") - prev("start") > 60, stretch=stretch, plain=1_000_000 if stretch == 40 else 0)
    got = {r["k"]: r["island"] for r in found.collect()}
    want = {1003: 1, 1000: 2, 1001: 2, 1002: 3}
    for key in {(r[0], r[1]) for r in rows}:
        last, number = None, 0
        for r in sorted((r for r in rows if (r[0], r[1]) == key), key=lambda r: (r[3], r[5], r[9])):
            number += last is None or r[3] - last > 60
            want[r[9]], last = number, r[3]
    assert got == want


def test_look_back_equals_a_sequential_scan(spark):
    df, rows = signals(spark, 200, 3, ("DEL",))
    win = df.withColumn("w", F.expr("start div 6000"))
    got = {r["k"]: r["cluster"] for r in lookback.look_back(win, ["chrom", "w"], ["sv_len", "k"], "low").collect()}
    want = {}
    for key in {(r[0], r[3] // 6000) for r in rows}:
        part = sorted((r for r in rows if (r[0], r[3] // 6000) == key), key=lambda r: (r[3], r[5], r[9]))
        root = []
        for i, r in enumerate(part):
            root.append(i)
            for j in range(i - 1, max(0, i - math.ceil(0.8 * len(part))) - 1, -1):
                p = part[j]
                reach = scalars.tolerance_of(p[5], "low")
                if min(p[5] / r[5], r[5] / p[5]) > 0.8 and (abs(p[3] - r[3]) <= reach or abs(p[4] - r[4]) <= reach):
                    root[i] = root[j]
                    break
        for i, r in enumerate(part):
            want[r[9]] = root[i] if root.count(root[i]) > 1 else -1
    assert got == want


def test_overlap_join_equals_nested_loops(spark):
    draw = random.Random(5)
    make = lambda n: [(f"c{draw.randrange(2)}", s := draw.randrange(0, 5_000_000), s + draw.choice([0, 10, 3000, 70_000, 2_000_000]), k) for k in range(n)]
    a, b = make(150), make(150)
    schema = "chrom string, start long, stop long, k long"
    got = intervals.overlap_join(spark.createDataFrame(a, schema), spark.createDataFrame(b, schema)).select("k", "r_k").collect()
    want = sorted((x[3], y[3]) for x in a for y in b if x[0] == y[0] and x[1] <= y[2] and x[2] >= y[1])
    assert sorted(map(tuple, got)) == want


def test_overlap_join_of_empty_tables(spark):
    none = spark.createDataFrame([], "chrom string, start long, stop long")
    assert intervals.overlap_join(none, none).count() == 0


@pytest.mark.parametrize(("depth", "support", "gt"), [(0, 0, "./."), (5, 4, "1/1"), (5, 1, "0/0"), (5, 2, "0/1"), (10, 9, "1/1"), (10, 1, "0/0"), (10, 2, "0/1"), (11, 9, "1/1"), (100, 4, "0/0"), (100, 5, "0/1")])
def test_depth_ladder(spark, depth, support, gt):
    assert spark.range(1).select(genotypes.by_depth(F.lit(support), F.lit(depth)).alias("g")).head()["g"] == gt


def test_deletion_uses_the_right_side_on_equal_support(spark):
    g = genotypes.deletion(F.lit(2), F.lit(2), F.lit(100), F.lit(2), F.lit(2), F.lit(4), F.lit(5000))
    assert spark.range(1).select(g.alias("g")).head()["g"] == "1/1"


def test_support_filter_modes(spark):
    df = spark.createDataFrame([(1, 0.9), (9, 0.1), (9, 0.9), (1, 0.1)], "cluster_size long, sv_rate double")
    counts = [filters.supported(df, *a).count() for a in ((5, None), (None, 0.5), (5, 0.5), (5, 0.5, True))]
    assert counts == [2, 2, 3, 1]


def test_mirror_twice_is_identity(spark):
    v = spark.createDataFrame([("c", 500, 600, "a"), ("c", 2000, 2100, "b")], "chrom string, start long, stop long, svid string")
    inv = spark.createDataFrame([("c", 400, 1000)], "chrom string, start long, stop long")
    once = nested.mirror(v, inv, ["svid"]).drop("mirrored")
    assert sorted(map(tuple, once.collect()))[0][1:] != (500, 600)
    back = nested.mirror(once, inv, ["svid"]).select("chrom", "start", "stop", "svid")
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, v.select("chrom", "start", "stop", "svid").collect()))


def test_contained_mirrors_follow_each_other(spark):
    draw = random.Random(8)
    inv = sorted({(a := draw.randrange(0, 3000), a + draw.randrange(100, 1500)) for _ in range(12)})
    rows = [("c", a := draw.randrange(0, 4000), a + draw.randrange(0, 200), k) for k in range(80)]
    want = {}
    for _, a, b, k in rows:
        for x, y in inv:
            if a >= x and b <= y:
                a, b = x + y - b, x + y - a
        want[k] = (a, b)
    schema = "chrom string, start long, stop long"
    got = nested.mirror_contained(spark.createDataFrame(rows, schema + ", k long"), spark.createDataFrame([("c", a, b) for a, b in inv], schema), ["k"])
    assert {r["k"]: (r["start"], r["stop"]) for r in got.collect()} == want


def test_reverse_complement_twice_is_identity(spark):
    df = spark.createDataFrame([("ACGTN",), ("",), (None,)], "s string")
    assert [r[0] for r in df.select(scalars.reverse_complement(scalars.reverse_complement(F.col("s")))).collect()] == ["ACGTN", "", None]


def test_invert_sequences(spark):
    seqs = spark.createDataFrame([("c", "AAAACCCC"), ("d", "GG")], "chrom string, seq string")
    inv = spark.createDataFrame([("c", 2, 6)], "chrom string, start long, stop long")
    assert {r["chrom"]: r["seq"] for r in nested.invert_sequences(seqs, inv).collect()} == {"c": "AAGGTTCC", "d": "GG"}


def test_one_cds_gene_keeps_its_ends_unless_asked(spark):
    genes = spark.createDataFrame([("g", "c", 1, 100, "+")], "gene string, chrom string, start long, stop long, strand string")
    cds = spark.createDataFrame([("g", 20, 50)], "gene string, start long, stop long")
    assert {r["part"] for r in annotation.gene_parts(genes, cds).collect()} == {"cds1", "utr5", "utr3"}
    assert {r["part"] for r in annotation.gene_parts(genes, cds, False).collect()} == {"cds1"}


def test_deletion_of_40_and_41_bases(spark):
    parts = spark.createDataFrame([("g", "c", "cds1", 1, 1000)], "gene string, chrom string, part string, start long, stop long")
    v = spark.createDataFrame([("c", 10, 50, "DEL", "a"), ("c", 10, 51, "DEL", "b")], "chrom string, start long, stop long, sv_type string, svid string")
    assert [(r["svid"], r["impact"], r["bases"]) for r in annotation.deletion_impact(v, parts).collect()] == [("b", "AS", 42)]


def test_phase_and_polyploid_spellings(spark):
    a = spark.createDataFrame([("v1", "0/1"), ("v2", "1/1"), ("v3", "1/1")], "id string, gt string")
    b = spark.createDataFrame([("v1", "1/1"), ("v2", "./."), ("v4", "0/0")], "id string, gt string")
    assert {r["id"]: r["gt"] for r in cohort.phase_two(a, b, ["id"]).collect()} == {"v1": "0|1", "v2": "1|.", "v3": "1|.", "v4": ".|0"}
    df = spark.createDataFrame([("0|1|.",), ("1|1|.",), ("0|.",), ("0|0",), (".|.",)], "p string")
    assert [r[0] for r in df.select(cohort.standard_call(F.col("p"))).collect()] == ["0/1", "1/1", "./0", "0/0", "."]


def test_cohort_merge_of_distant_rows_is_identity(spark):
    df = spark.createDataFrame([("c", "DEL", k * 5000, k * 5000 + 99, 100, 30, k) for k in range(20)], "chrom string, sv_type string, start long, stop long, sv_len long, maq int, k long")
    merged = clusters.cohort_merge(windows.adjacent(df, ["chrom", "sv_type"], ["k"], 50), ["chrom", "sv_type"], ["start", "stop", "sv_len"])
    assert merged.count() == 20 and merged.agg(F.max("merged")).head()[0] == 1


def test_adjacent_bounds(spark):
    rows = [("c", "DEL", 0, 99, 100, 0), ("c", "DEL", 100, 199, 100, 1), ("c", "DEL", 201, 300, 100, 2), ("c", "INS", 0, 99, 80, 3), ("c", "INS", 10, 99, 100, 4)]
    df = spark.createDataFrame(rows, "chrom string, sv_type string, start long, stop long, sv_len long, k long")
    got = {r["k"]: r["island"] for r in windows.adjacent(df, ["chrom", "sv_type"], ["k"], 100).collect()}
    assert got == {0: 1, 1: 1, 2: 2, 3: 1, 4: 2}


def test_cigar_with_equal_and_clip_operations(spark):
    df = spark.createDataFrame([("q", 0, "c", 100, 60, "5H10=2X50D3I10M7S", "A" * 25, None)], "qname string, flag int, rname string, pos long, mapq int, cigar string, seq string, sa string")
    found = alignments.cigar_signals(df, 40).collect()
    assert [(r["start"], r["stop"], r["sv_len"], r["sv_type"]) for r in found] == [(112, 161, 50, "DEL")]
    assert tuple(df.select(alignments.clips(F.col("cigar"))).head()[0]) == (5, 25, 7)


def test_until_stable_stops(spark):
    seqs = spark.createDataFrame([("c", "AAAACCCCGGGG")], "chrom string, seq string")
    left = [2, 1, 1]

    def call(_):
        n = left.pop(0)
        return spark.createDataFrame([("c", k, k + 4, "INV") for k in range(n)], "chrom string, start long, stop long, sv_type string")

    _, found = nested.until_stable(call, seqs)
    assert len(found) == 3


def test_primers_score_and_bounds(spark):
    draw = random.Random(2)
    seq = "".join(draw.choice("ACGT") for _ in range(1500))
    table = spark.createDataFrame([("a", seq, 200), ("b", "N" * 1500, 200)], "id string, seq string, sv_size long")
    found = markers.primer_candidates(table)
    best = markers.best_primers(found, table).collect()
    assert [r["id"] for r in best] == ["a"] and best[0]["score"] <= 100 and 100 <= best[0]["alt_size"] < best[0]["ref_size"] <= 1500
    assert markers.outermost_primers(found, table).head()["ref_size"] <= best[0]["ref_size"]


def test_primers_against_all_windows_and_pairs(spark):
    draw = random.Random(5)
    seqs = {"a": "".join(draw.choice("ACGT") for _ in range(420)), "b": "".join(draw.choice("ACGGCN") for _ in range(420)), "c": "ACGT", "d": None}
    table = spark.createDataFrame([(k, v, 60 if k != "b" else -60) for k, v in seqs.items()], "id string, seq string, sv_size long")
    flip = str.maketrans("ACGT", "TGCA")
    want = []
    for k, seq in seqs.items():
        for side, low in (("forward", 0), ("reverse", max(0, len(seq or "") - 40))):
            for at in range(low, min(low + 40, len(seq or ""))):
                for size in range(18, 25):
                    piece = (seq or "")[at : min(at + size, low + 40)]
                    if len(piece) == size and not set(piece) - set("ACGT") and 35 <= 100 * sum(c in "GC" for c in piece) / size <= 65 and 50 <= markers.melting_temperature(piece) <= 66:
                        want.append((k, side, at if side == "forward" else at + size - 1, piece if side == "forward" else piece.translate(flip)[::-1], round(markers.melting_temperature(piece), 6)))
    candidates = markers.primer_candidates(table, tm=(50.0, 66.0), gc=(35.0, 65.0), flank=40)
    got = candidates.collect()
    assert sorted((r["id"], r["side"], r["pos"], r["primer"], round(r["tm"], 6)) for r in got) == sorted(want) and want
    best = {r["id"]: r["score"] for r in markers.best_primers(candidates, table).collect()}
    gone = lambda gc: max(0, 40 - gc, gc - 60) * 0.5
    for k, differ in (("a", 60), ("b", -60)):
        scores = [100 - max(0, markers.pairing_temperature(f["primer"], r["primer"]) - 45) * 2 - max(0, abs(f["tm"] - r["tm"]) - 3) * 5 - gone(f["gc"]) - gone(r["gc"])
                  for f in got for r in got if f["id"] == r["id"] == k and (f["side"], r["side"]) == ("forward", "reverse") and 100 <= r["pos"] - f["pos"] + 1 - differ <= 1500]
        assert (k in best) == bool(scores) and (not scores or abs(best[k] - max(scores)) < 1e-9)


def test_melting_temperature_grows_with_gc():
    assert markers.melting_temperature("GCGCGCGCGCGCGCGCGC") > markers.melting_temperature("ATATATATATATATATAT")


def test_evidence_counts_events_and_spans(spark):
    reads = spark.createDataFrame(
        [("s", "a", 0, "c", 100, 60, "400M100D400M", None), ("s", "b", 0, "c", 100, 60, "900M", None), ("s", "d", 0, "c", 100, 60, "400M500S", None), ("s", "e", 4, "c", 100, 0, "900M", None)],
        "sample string, qname string, flag int, rname string, pos long, mapq int, cigar string, sa string")
    variant = spark.createDataFrame([("v", "c", 500, 600, 100, "DEL")], "vid string, chrom string, start long, stop long, size long, sv_type string")
    row = genotypes.deletion_evidence(variant, reads).where("side = 'l'").head()
    assert (row["reads"], row["events"], row["clips"], row["maq"]) == (3, 1, 1, 60)
    assert genotypes.long_read_calls(variant, reads, ["s", "t"]).select("sample", "gt").orderBy("sample").collect() == [("s", "0/1"), ("t", "./.")]


def test_rounds_are_joined_at_the_places_of_the_first(spark):
    schema = "chrom string, start long, stop long, sv_type string, svid string"
    first = spark.createDataFrame([("c", 1000, 2000, "INV", "a"), ("c", 50, 60, "DEL", "b")], schema)
    second = spark.createDataFrame([("c", 1100, 1200, "INV", "d"), ("c", 1300, 1350, "DEL", "e"), ("c", 50, 60, "DEL", "b")], schema)
    got = nested.joined_rounds([first, second], lambda t: t.dropDuplicates(["svid"]), ["svid"])
    assert {r["svid"]: (r["start"], r["stop"]) for r in got.collect()} == {"a": (1000, 2000), "b": (50, 60), "d": (1800, 1900), "e": (1650, 1700)}
    assert nested.joined_rounds([first], lambda t: t, ["svid"]).count() == 2
