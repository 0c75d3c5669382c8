"""Islands are grouped where they were numbered, in stretches as in plain windows."""

from pyspark.sql import functions as F

from strandmill.operators import runs


def test_groups_of_islands_do_not_move_again(spark):
    rows = spark.range(3000).selectExpr("if(id % 7 = 0, null, id % 3) as k", "id * 37 % 2111 as start", "id as t", "id % 11 as v")
    work = lambda rows, by: rows.groupBy(*by, "island").agg(F.mode("v", True).alias("v"), F.sum("t").alias("t"))
    done = lambda plain: runs.by_island(rows, ["k"], ["start", "t"], lambda prev: F.col("start") > prev("start") + 2, work, stretch=5, plain=plain)
    cut, whole = done(0), done(10_000)
    assert sorted(map(str, cut.collect())) == sorted(map(str, whole.select(cut.columns).collect())) and cut.count() > 300
    plan = cut._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[-1]
    islands = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line and "island" in line]
    assert len(islands) == 1  # only islands over an edge are gathered
