"""Findings of the third round: comparisons in whole numbers, islands in stretches."""

from pyspark.sql import functions as F

from strandmill.operators import clusters, genotypes, runs, sequences


def test_seven_tenths_of_a_size_are_whole_numbers(spark):
    variants = spark.createDataFrame([("a", "c", 5000, 5090, 90)], "vid string, chrom string, start long, stop long, size long")
    rows = [(f"q{n}", 0, "c", 4900, 40, f"120M{n}I200M", "s0") for n in (63, 64, 134, 135)]
    reads = spark.createDataFrame(rows, "qname string, flag int, rname string, pos long, mapq int, cigar string, sample string")
    found = genotypes.small_duplication_evidence(variants, reads).collect()
    assert [(r["reads"], r["events"]) for r in found] == [(4, 2)]  # 64 and 134


def test_edges_of_stretches_carry_what_starts_reads(spark):
    rows = spark.range(400).selectExpr("if(id % 7 = 0, null, id % 3) as k", "id * 37 % 211 as start", "id as t", "'x' as bulk")
    marked = lambda plain: runs.islands(rows, ["k"], ["start", "t"], lambda prev: F.col("start") > prev("start") + 2, stretch=3, plain=plain)
    cut = marked(0)
    assert sorted(map(str, cut.collect())) == sorted(map(str, marked(1000).select(cut.columns).collect()))
    assert "bulk" not in cut.select("t", "island")._jdf.queryExecution().optimizedPlan().toString()


def test_merged_rows_carry_their_rank_once(spark):
    rows = spark.createDataFrame([("a", 1, 5, 9, "s1", "*", 40, 20, 2, 0.5, 1), ("a", 1, 4, 8, "s2", "*", 90, 31, 2, 0.25, 2), ("a", 1, 3, 7, "s3", "*", 10, 30, 1, 0.1, 3)], "chrom string, island long, start long, stop long, svid string, seq string, sv_len long, maq int, cluster_size long, sv_rate double, k long")
    merged = clusters.sample_merge(rows, ["chrom"], ["k"])
    assert merged.columns == ["chrom", "island", "start", "stop", "svid", "seq", "sv_len", "maq", "cluster_size", "sv_rate"]
    assert [tuple(r) for r in merged.collect()] == [("a", 1, 4, 8, "s2", "*", 90, 27, 5, 0.85)]
    assert merged._jdf.queryExecution().optimizedPlan().toString().count("max_by(") == 1


def test_chains_are_worked_out_in_batches(spark):
    seqs = {str(k): "ACGTTGCAAC"[k % 5 :] * 5 for k in range(40)}
    places = {c: [(int(c) % 7, 9 + int(c) % 7), (20, 31), (27, 60)] for c in seqs}
    store = sequences.chunked(spark.createDataFrame(list(seqs.items()), "chrom string, seq string"), 8)
    found = spark.createDataFrame([(c, a, b) for c, own in places.items() for a, b in own], "chrom string, start long, stop long")
    made = sequences.inverted(store, found, 8)
    assert "FlatMapGroupsInPandas" not in made._jdf.queryExecution().executedPlan().toString()
    texts = {c: "" for c in seqs}
    for r in sorted(made.collect(), key=lambda r: (r["chrom"], r["chunk"])):
        texts[r["chrom"]] += r["text"]
    for c, seq in seqs.items():
        for a, b in reversed(places[c]):
            seq = seq[:a] + seq[a:b].translate(str.maketrans("ACGT", "TGCA"))[::-1] + seq[b:]
        assert texts[c] == seq


def test_forced_calls_join_reads_once_for_each_kind(spark, monkeypatch):
    called = []
    evidence = genotypes.breakpoint_evidence
    monkeypatch.setattr(genotypes, "breakpoint_evidence", lambda *a, **b: (called.append(1), evidence(*a, **b))[1])
    kinds = [("i", "INS", 50), ("d", "DEL", 60), ("s", "DUP", 70), ("l", "DUP", 4000), ("v", "INV", 900), ("t", "TRA", 0)]
    given = spark.createDataFrame([(k, t, "c", 5000, "c", 5000 + n, n) for k, t, n in kinds], "vid string, sv_type string, chrom string, start long, chrom2 string, stop long, size long")
    reads = spark.createDataFrame([("q", 0, "c", 4000, 40, "3000M", None, "s0")], "qname string, flag int, rname string, pos long, mapq int, cigar string, sa string, sample string")
    found = genotypes.forced_calls(given, reads, ["s0"]).select("vid").collect()
    assert len(called) == 1 and sorted(r["vid"] for r in found) == sorted(k for k, _, _ in kinds)
