"""Interval joins that hold their smaller side, and evidence from one join."""

from pyspark.sql import functions as F

from strandmill.operators import genotypes, intervals
from strandmill.plans.cohorts import align
from strandmill.plans.projection import spark_table


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _sides(spark):
    few = spark.range(300).select(F.lit("c").alias("chrom"), (F.col("id") * 700).alias("start"), (F.col("id") * 700 + 90).alias("stop"))
    many = spark.range(4000).select(F.lit("c").alias("chrom"), (F.col("id") * 53).alias("start"), (F.col("id") * 53 + F.col("id") % 3000).alias("stop"))
    return few, many


def test_smaller_side_is_held_and_larger_one_not_sorted(spark, monkeypatch):
    monkeypatch.setattr(intervals, "SMALL", 100)
    few, many = _sides(spark)
    wanted = few.alias("a").join(many.alias("b"), F.expr("a.chrom = b.chrom and a.start <= b.stop and a.stop >= b.start")).count()
    for left, right in ((few, many), (many, few)):
        met = intervals.overlap_join(left, right)
        assert "ShuffledHashJoin" in _plan(met) and "SortMergeJoin" not in _plan(met)
        assert met.count() == wanted
    unread = intervals.overlap_join(few, many, sizes=intervals.left_levels(few, "start", "stop"))
    assert "ShuffledHashJoin" in _plan(unread) and unread.count() == wanted
    monkeypatch.setattr(intervals, "HELD_IN_TASK", 10)
    both = intervals.overlap_join(few, many)
    assert "SortMergeJoin" in _plan(both) and both.count() == wanted


def test_reads_move_without_what_no_variant_reads(spark, sf, monkeypatch):
    moved = []
    join = genotypes.overlap_join
    monkeypatch.setattr(genotypes, "overlap_join", lambda left, right, *a, **k: moved.append(right) or join(left, right, *a, **k))
    genotypes.insertion_evidence(spark_table(spark, sf, "var"), align(spark, sf))
    rows = moved[0]
    assert dict(rows.dtypes)["clip_l"] == dict(rows.dtypes)["clip_r"] == "boolean"
    assert rows.where("dels is not null").isEmpty() and rows.where("inss is null").isEmpty()
