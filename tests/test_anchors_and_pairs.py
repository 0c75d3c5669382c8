"""Anchored windows and look-back at any density, pairs of pieces, rounding, rules by hand-worked rows."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from strandmill.functions import scalars
from strandmill.operators import alignments, anchors, clusters, cohort, genotypes, lookback, markers, windows
from strandmill.plans.catalog import expanded


def sequential(at, reach, widest):
    out, island, window, anchor, limit = [], 0, 0, None, None
    for k, (a, r) in enumerate(zip(at, reach)):
        if not k or a - at[k - 1] >= widest:
            island, window, anchor, limit = island + 1, 1, a, a + r
        elif a >= limit:
            window, anchor, limit = window + 1, a, a + r
        out.append((island, window, anchor))
    return out


@pytest.mark.parametrize("seed", range(40))
def test_step_functions_compose_to_the_sequential_fold(seed):
    draw = np.random.default_rng(seed)
    for _ in range(25):
        n, widest = int(draw.integers(1, 80)), float(draw.choice([5, 20, 100]))
        at = np.sort(draw.integers(0, draw.choice([20, 200, 1000]), n))
        reach = draw.uniform(0.5, widest, n)
        state, got = anchors.State(), []
        for a, b in zip(cuts := [0, *sorted(draw.integers(0, n + 1, 4).tolist()), n], cuts[1:]):
            if a == b:
                continue
            opening, inner, after = anchors.Opening(widest), 0, state
            for x, y in zip(inside := [a, *sorted(draw.integers(a, b + 1, 3).tolist()), b], inside[1:]):
                if x == y:
                    continue
                inner += int(anchors.breaks(at[x:y], opening.last if opening.after is None else opening.after.last, widest).sum()) - (opening.first is None)
                opening.feed(at[x:y], reach[x:y])
                *marks, after = anchors.mark(at[x:y], reach[x:y], after, widest)
                got += zip(*(m.tolist() for m in marks))
            assert opening.apply(state, inner) == after
            state = after
        assert got == sequential(at.tolist(), reach.tolist(), widest)


def test_one_dense_island_is_many_partitions(spark):
    """A chromosome without a gap: the rows of its one island lie in many partitions, and windows go on over their edges."""
    draw = random.Random(4)
    rows = sorted((draw.randrange(200_000), draw.choice([40, 99, 100, 300, 700, 1500]), k) for k in range(40_000))
    df = spark.createDataFrame([("c", "DEL", a, s, k) for a, s, k in rows], "chrom string, sv_type string, start long, sv_len long, k long")
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        found = windows.adaptive_windows(df, ["chrom", "sv_type"], ["sv_len", "k"])
        sizes = found.groupBy(F.spark_partition_id()).count().collect()
        got = {r["k"]: (r["island"], r["window"], r["anchor"]) for r in found.collect()}
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)
    assert len(sizes) >= 3 and max(r["count"] for r in sizes) < 25_000
    want = sequential([r[0] for r in rows], windows.adaptive_width(np.array([r[1] for r in rows])).tolist(), windows.WIDEST)
    assert got == {k: w for (_, _, k), w in zip(rows, want)}


def test_anchored_edges(spark):
    schema = "chrom string, sv_type string, start long, sv_len long, k long, island string"
    assert windows.adaptive_windows(spark.createDataFrame([], schema).drop("island"), ["chrom", "sv_type"], ["k"]).collect() == []
    rows = [(None, "DEL", 10, 50, 1, "x"), (None, "DEL", 20, 50, 2, "x"), ("a", "DEL", None, 50, 3, "x"), ("a", "DEL", None, 50, 4, "x"), ("a", "DEL", 5, None, 5, "x"), ("a", "DEL", 1504, 50, 6, "x"), ("a", None, 5, 50, 7, "x")]
    found = windows.adaptive_windows(spark.createDataFrame(rows, schema).withColumnRenamed("island", "__own"), ["chrom", "sv_type"], ["k"])
    got = {r["k"]: (r["island"], r["window"], r["anchor"]) for r in found.collect()}
    assert got == {1: (1, 1, 10), 2: (1, 1, 10), 3: (1, 1, None), 4: (1, 1, None), 5: (2, 1, 5), 6: (2, 1, 5), 7: (1, 1, 5)}


def nearest(window, start, stop, size, reach, back):
    for i in range(len(start)):
        for j in range(i - 1, max(-1, i - back[i] - 1), -1):
            if window[j] != window[i]:
                break
            if size[i] > 0 and size[j] > 0 and min(size[i] / size[j], size[j] / size[i]) > 0.8 and (abs(start[i] - start[j]) <= reach[j] or abs(stop[i] - stop[j]) <= reach[j]):
                yield j
                break
        else:
            yield i
            continue
        if window[j] != window[i]:
            yield i


@pytest.mark.parametrize("seed", range(30))
def test_indexed_look_back_equals_a_scan(seed):
    draw = np.random.default_rng(seed)
    for _ in range(8):
        n, count = int(draw.integers(1, 60)), int(draw.integers(1, 4))
        window = np.sort(draw.integers(0, count, n))
        start = np.empty(n, np.int64)
        for w in range(count):
            start[window == w] = np.sort(draw.integers(0, draw.choice([50, 3000, 10**6, 10**15]), (window == w).sum()))
        size = draw.choice([0, 40, 50, 60, 99, 100, 101, 500, 900, 5000, 6000], n).astype(float)
        stop, reach = start + draw.integers(0, 4000, n), lookback.tolerances(size, str(draw.choice(["high", "low", "high_ins"])))
        many = np.searchsorted(window, window, "right") - np.searchsorted(window, window, "left")
        back = np.ceil(0.8 * many).astype(np.int64)
        assert lookback.parents(window, start, stop, size, reach, 0.8, back).tolist() == list(nearest(window, start, stop, size, reach, back))


def test_look_back_of_a_very_large_window():
    draw = np.random.default_rng(0)
    n = 100_000
    start, size = np.sort(draw.integers(0, 240, n)), draw.integers(40, 400, n).astype(float)
    found = lookback.parents(np.zeros(n, np.int64), start, start + size.astype(int), size, lookback.tolerances(size, "low"), 0.8, np.full(n, 80_000))
    assert (found <= np.arange(n)).all() and len(np.unique(lookback.numbered(found, np.zeros(n, np.int64)))) > 1


def test_rounding_is_that_of_the_binary_value(spark):
    draw = random.Random(2)
    values = [0.0625, 2.675, 0.0005, 1.005, 0.5, 1.5, 0.125, 0.375, 1e-9, 0.0, 2.5, 1 / 3, -0.0625, -2.675] + [draw.randrange(200) / draw.randrange(1, 200) for _ in range(3000)]
    rows = spark.createDataFrame([(x,) for x in values], "x double").select("x", *[scalars.round_half_even(F.col("x"), d).alias(f"r{d}") for d in (1, 2, 3)]).collect()
    assert all(r[f"r{d}"] == round(r["x"], d) for r in rows for d in (1, 2, 3))
    import duckdb

    sql = expanded("SELECT half_even(x, 3) AS r FROM (SELECT unnest($1) AS x)")
    assert [r[0] for r in duckdb.execute(sql, [[abs(v) for v in values]]).fetchall()] == [round(abs(v), 3) for v in values]


PIECE = "qname string, flag int, chrom string, start long, stop long, clip struct<left: bigint, mapped: bigint, right: bigint>, mapq int"


def test_a_short_primary_counts_and_short_supplements_do_not(spark):
    rows = [("a", 0, "c", 1000, 1250, (0, 250, 900), 60), ("a", 2048, "c", 1500, 2400, (250, 900, 0), 60), ("b", 0, "c", 1000, 1900, (0, 900, 250), 60), ("b", 2048, "c", 2500, 2750, (900, 250, 0), 60)]
    segs = spark.createDataFrame(rows, PIECE)
    assert [r["qname"] for r in alignments.segment_pairs(segs).collect()] == ["a"]
    found = alignments.split_signals(alignments.segment_pairs(segs)).collect()
    assert [(r["sv_type"], r["start"], r["stop"], r["sv_len"]) for r in found] == [("DEL", 1250, 1499, 250), ("INS", 1250, 1251, 0)][:1]
    # contigs: 250 mapped bases are enough, the piece of smallest chromosome and place is the primary
    assert sorted(r["qname"] for r in alignments.segment_pairs(segs, assembly=True).collect()) == ["a", "b"]
    other = spark.createDataFrame([("x", 0, "d", 5, 905, (0, 900, 900), 60), ("x", 2048, "c", 9000, 9900, (900, 900, 0), 60)], PIECE)
    assert [(r["p"]["chrom"], r["q"]["chrom"]) for r in alignments.segment_pairs(other, assembly=True).collect()] == [("c", "d")]
    # without any piece that is no supplement there are no pairs
    assert alignments.segment_pairs(other.where("flag > 16"), assembly=True).count() == 0


def signal_rows(pairs):
    found = alignments.split_signals(pairs, exact_mapq=60).drop("svid", "seq")
    return sorted(tuple(r) for r in found.collect())


def test_banded_pairs_lose_no_signal(spark):
    draw = random.Random(9)
    rows = list({(f"q{draw.randrange(3)}", draw.choice([0, 16, 2048, 2064]), draw.choice("cd"), draw.randrange(0, 60) * 100, draw.randrange(4000, 9000), (draw.randrange(0, 30) * 100, draw.randrange(1, 9) * 100, draw.randrange(0, 30) * 100), draw.choice([60, 60, 60, 20])) for _ in range(150)})
    segs = spark.createDataFrame(rows, PIECE)
    names = [c for c in segs.columns if c != "qname"]
    side = lambda n: segs.distinct().select("qname", F.struct(*names).alias(n))
    every = side("l").join(side("r"), "qname").where("l.start < r.start and greatest(l.clip.mapped, r.clip.mapped) >= 250 or l.start = r.start and l <> r and l.clip.mapped >= 250")
    got = alignments.banded_pairs(segs)
    assert got.count() == got.distinct().count() < every.count()
    assert signal_rows(got) == signal_rows(every.withColumns({"p": F.col("l"), "q": F.col("r")})) != []
    order = spark.createDataFrame([("c", 1), ("d", 2)], "chrom string, rank int")
    across = side("p").join(side("q"), "qname").where("p.chrom < q.chrom and greatest(p.clip.mapped, q.clip.mapped) >= 250").withColumns({"l": F.col("p"), "r": F.col("q")})
    tra = lambda pairs: sorted(tuple(r) for r in alignments.translocation_signals(pairs, order).collect())
    assert tra(got) == tra(across) != []


READS = "sample string, qname string, flag int, rname string, pos long, mapq int, cigar string, sa string"
VARIANT = "vid string, chrom string, start long, chrom2 string, stop long, size long, sv_type string"


def test_forced_calls_by_hand(spark):
    """Ten reads: an insertion of 900 within half and twice its size, clips, spans; a deletion; an inversion by clips."""
    rows = [
        *[("s", f"i{k}", 0, "c", 4000, 60, "1000M500I1500M", None) for k in range(3)],  # fits: over half of 900
        ("s", "j", 0, "c", 4000, 60, "1000M400I1500M", None),  # too short, and it spans: 4000 + 1000 < 5010 is false
        ("s", "k", 0, "c", 3000, 60, "4000M", None),  # spans
        ("s", "u", 4, "c", 4000, 0, "1000M500I1500M", None),  # unmapped
        *[("s", f"d{k}", 0, "c", 20000, 60, "1000M300D1000M", None) for k in range(2)],
        ("s", "e", 0, "c", 20000, 50, "1000M1000S", None),
        *[("s", f"v{k}", 0, "c", 30000, 60, "1000M500S", None) for k in range(4)], ("s", "w", 0, "c", 30000, 60, "2000M", None),
    ]
    reads = spark.createDataFrame(rows, READS)
    given = spark.createDataFrame([("ins", "c", 5010, "c", 5011, 900, "INS"), ("del", "c", 21000, "c", 21299, 300, "DEL"), ("inv", "c", 31000, "c", 61000, 30000, "INV")], VARIANT)
    got = {r["vid"]: r for r in genotypes.forced_calls(given, reads, ["s", "t"]).where("sample = 's'").collect()}
    # five reads there, three with a fitting insertion, one across it less three fitting ones: floor(0.75 * 5) + 1 = 4 > 3
    assert (got["ins"]["gt"], got["ins"]["reads_l"], got["ins"]["ratio_l"], got["ins"]["maq"]) == ("0/1", 5, 0.6, 60)
    # left: all three reads support it; right: the clipped read does not reach it
    assert (got["del"]["gt"], got["del"]["reads_l"], got["del"]["ratio_l"], got["del"]["reads_r"], got["del"]["ratio_r"]) == ("0/1" if 3 < math.floor(0.75 * 3) + 1 else "1/1", 3, 1.0, 2, 1.0)
    assert (got["inv"]["gt"], got["inv"]["reads_l"], got["inv"]["reads_r"], got["inv"]["ratio_l"]) == ("1/1", 5, 0, 0.8)
    assert {r["gt"] for r in genotypes.forced_calls(given, reads, ["t"]).collect()} == {"./."}
    assert genotypes.forced_calls(given.limit(0), reads, ["s"]).count() == 0


def test_rates_change_long_read_calls(spark):
    reads = spark.createDataFrame([("s", f"a{k}", 0, "c", 100, 60, "400M100D400M" if k < 6 else "900M", None) for k in range(12)], READS)
    variant = spark.createDataFrame([("v", "c", 500, 600, 100, "DEL")], "vid string, chrom string, start long, stop long, size long, sv_type string")
    call = lambda **rates: genotypes.long_read_calls(variant, reads, ["s"], **rates).head()["gt"]
    assert (call(), call(homo=0.5), call(homo=0.9, ref=0.6)) == ("0/1", "1/1", "0/0")


def test_windows_kept_by_their_rules(spark):
    rows = [("c", "DEL", 1, 1, f"r{k}", 40) for k in range(3)] + [("c", "DEL", 2, 1, "r0", 40)] + [("c", "INS", 1, 1, "r0", 6000)]
    marked = spark.createDataFrame(rows, "chrom string, sv_type string, island long, window long, query_name string, sv_len long")
    kept = lambda df: sorted({(r["sv_type"], r["island"]) for r in df.collect()})
    assert kept(windows.kept_fixed_windows(marked, ["chrom", "sv_type"], 1.0)) == [("DEL", 1)]
    assert kept(windows.kept_fixed_windows(marked, ["chrom", "sv_type"], 0.03)) == []
    assert kept(windows.kept_break_windows(marked, ["chrom", "sv_type"], 1.0)) == [("DEL", 1), ("DEL", 2), ("INS", 1)]
    assert kept(windows.kept_break_windows(marked, ["chrom", "sv_type"], 1.0, 6)) == [("DEL", 1), ("INS", 1)]
    assert (clusters.least_rate(2), clusters.least_rate(9), clusters.least_rate(4, "cr"), clusters.default_reads(59.9)) == (0.49, 0.12, 0.99, 5)


def test_shifted_insertions_and_text_order(spark):
    reads = spark.createDataFrame([("q", "c", 100, 60, "5M50I5M", "ACGTA" + "T" * 49 + "G" + "CCCCC")], "qname string, rname string, pos long, mapq int, cigar string, seq string")
    plain, shifted = (alignments.cigar_signals(reads, shifted=x).head() for x in (False, True))
    assert (plain["seq"], shifted["seq"]) == ("T" * 49 + "G", "T" * 48) and plain["start"] == 105
    table = spark.createDataFrame([("a", "c", 10), ("b", "c", 9), ("d", "c", 100)], "id string, chrom string, pos long")
    assert [r["id"] for r in cohort.in_order(table, as_text=True).collect()] == ["a", "d", "b"]
    assert [r["id"] for r in cohort.in_order(table).collect()] == ["b", "a", "d"]
    order = spark.createDataFrame([(c,) for c in ("chrX", "Y", "M", "chr12", "scaffold")], "c string").select(scalars.chrom_order(F.col("c"), mito=True)).collect()
    assert [r[0] for r in order] == [100, 101, 102, 12, 999]


def all_duplexes(a, b):
    """Every chain of pairs of two strands, by recursion: (free energy at 37 degrees, heat, order) of the most stable."""
    flip = b.translate(str.maketrans("ACGT", "TGCA"))[::-1]
    salt = 0.368 * math.log(markers.SALT)
    stack = lambda x, y: markers.STACKS.get(x + y) or markers.STACKS[(x + y).translate(str.maketrans("ACGT", "TGCA"))[::-1]]
    weak = lambda i: 1 if a[i] in "AT" else 0
    best = (math.inf, 0, 0)

    def grow(i, j, heat, order):
        nonlocal best
        h, s = heat + 2.2 * weak(i), order + 6.9 * weak(i)
        best = min(best, (h - markers.WARM * s / 1000, h, s))
        for p in range(5):
            for q in range(5):
                x, y = i + 1 + p, j + 1 + q
                if x < len(a) and y < len(flip) and a[x] == flip[y]:
                    n = p + q
                    loop = 0 if not n else markers.BULGES[n - 1] if not p or not q else markers.MISMATCH if n == 2 else markers.INTERNAL[n - 3]
                    dh, ds = stack(a[i], a[x]) if n <= 1 else (0, 0)
                    grow(x, y, heat + dh, order + ds + (salt if n <= 1 else 0) - 1000 * loop / markers.WARM)

    for i in range(len(a)):
        for j in range(len(flip)):
            if a[i] == flip[j]:
                grow(i, j, 0.2 + 2.2 * weak(i), -5.7 + 6.9 * weak(i))
    return best


def test_duplexes_by_hand_and_by_all_chains():
    # GCGC with itself: GC, CG, GC stacks: heat 0.2 - 9.8 - 10.6 - 9.8 = -30.0, order -5.7 - 24.4 - 27.2 - 24.4 + 3 * 0.368 ln 0.05 = -85.007
    warm, free = markers.duplexes(["GCGC"], ["GCGC"])
    order = -5.7 - 24.4 - 27.2 - 24.4 + 3 * 0.368 * math.log(0.05)
    assert free[0] == pytest.approx(-30.0 - 310.15 * order / 1000) and warm[0] == pytest.approx(-30_000 / (order + 1.987 * math.log(50e-9 / 4)) - 273.15)
    assert markers.duplexes(["AAAA"], ["AAAA"])[0][0] == -273.15 and markers.duplexes([], [])[0].tolist() == []
    # a whole primer and its complement: the stack estimate of the primer itself
    primer = "ACGTTGCAAGGCTCAGTC"
    assert markers.pairing_temperature(primer, primer.translate(str.maketrans("ACGT", "TGCA"))[::-1]) == pytest.approx(markers.melting_temperature(primer))
    draw = random.Random(1)
    first, second = (["".join(draw.choices("ACGT", k=draw.randrange(3, 9))) for _ in range(60)] for _ in range(2))
    warm, free = markers.duplexes(first, second)
    for a, b, t, g in zip(first, second, warm, free):
        energy, heat, order = all_duplexes(a, b)
        assert g == pytest.approx(0.0 if energy == math.inf else energy), (a, b)
        assert t == pytest.approx(-273.15 if energy == math.inf else max(-273.15, 1000 * heat / (order + 1.987 * math.log(markers.DNA / 4)) - 273.15), abs=1e-6) or energy != math.inf
    # a mismatch or a bulge in the middle is weaker than no mismatch, and still pairs
    whole, mismatch, bulge = markers.duplexes(["GGCCGATTACGGCC"] * 3, ["GGCCGTAATCGGCC", "GGCCGTAGTCGGCC", "GGCCGTATCGGCC"])[1]
    assert whole < mismatch < 0 and whole < bulge < 0
