"""Evidence of insertions and deletions from one interval join."""

from strandmill.operators import genotypes
from strandmill.plans.cohorts import align
from strandmill.plans.projection import spark_table


def test_insertions_and_deletions_meet_the_reads_once(spark, sf, monkeypatch):
    met = []
    join = genotypes.overlap_join
    monkeypatch.setattr(genotypes, "overlap_join", lambda *a, **k: met.append(1) or join(*a, **k))
    variants, reads = spark_table(spark, sf, "var"), align(spark, sf)
    genotypes.short_read_calls(variants, reads, ["s0"])
    assert len(met) == 1
    genotypes.assembly_calls(variants, reads, ["s0"])
    assert len(met) == 2
