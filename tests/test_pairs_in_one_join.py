"""Pairs and given variants of all kinds meet the reads in one interval join, and reads are taken apart once."""

import pytest

from strandmill.operators import genotypes

KINDS = [("i", "INS", 50), ("d", "DEL", 60), ("s", "DUP", 70), ("l", "DUP", 4000), ("v", "INV", 900), ("t", "TRA", 0)]


@pytest.mark.parametrize("calls, kinds", [(genotypes.long_read_pair_calls, "slvt"), (genotypes.forced_calls, "idslvt")])
def test_all_kinds_meet_the_reads_once(spark, monkeypatch, calls, kinds):
    met = []
    join = genotypes.overlap_join
    monkeypatch.setattr(genotypes, "overlap_join", lambda *a, **k: met.append(1) or join(*a, **k))
    given = spark.createDataFrame([(k, t, "c", 5000, "c", 5000 + n, n) for k, t, n in KINDS], "vid string, sv_type string, chrom string, start long, chrom2 string, stop long, size long")
    # a read without quality has no say in both ends of duplications and inversions
    rows = [("q", 0, "c", 4000, 40, "3000M", None, "s0"), ("p", 0, "c", 4000, None, "3000M", None, "s0")]
    reads = spark.createDataFrame(rows, "qname string, flag int, rname string, pos long, mapq int, cigar string, sa string, sample string")
    found = {r["vid"]: r["reads_l"] for r in calls(given, reads, ["s0"]).collect()}
    assert len(met) == 1
    assert found == {k: 1 if k in "lv" else 2 for k in kinds}


def test_filters_do_not_take_reads_apart_again(spark):
    reads = spark.createDataFrame([("q", 0, "c", 10, 40, "5S20M3D4I6M", "s0")], "qname string, flag int, rname string, pos long, mapq int, cigar string, sample string")
    lines = genotypes.aligned(reads, 1)
    plan = lines.where("start <= last and last > 3")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_extract_all") == 1
    row = lines.head()
    assert (row["start"], row["last"], row["clip_l"], row["clip_r"]) == (10, 38, 10, None)
    assert [tuple(o) for o in row["dels"]] == [(3, 30)] and [tuple(o) for o in row["inss"]] == [(4, 33)]
