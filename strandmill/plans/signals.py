"""Queries on signals: filters, collapse, windows, clusters, merges."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandmill.operators import clusters, filters, genotypes, intervals, lookback, runs, windows
from strandmill.plans.catalog import query
from strandmill.plans.projection import cte, spark_table

K = ["k1", "k2", "k3", "k4"]
ORDER = ["sv_len", *K]
KEYS = ["chrom", "sv_type"]
BY = "PARTITION BY chrom, sv_type ORDER BY start, sv_len, k1, k2, k3, k4"


def sig(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark_table(spark, sf_dir, "sig")


@query(cte("sig") + " SELECT * FROM sig WHERE sv_len >= 100 AND sv_len <= 800 AND maq >= 30")
def sv_signal_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filters.signal_sizes(sig(spark, sf_dir), 100, 800, 30)


@query(cte("sig") + " SELECT svid, chrom, sv_type, cluster_size, sv_rate FROM sig WHERE cluster_size >= 5 OR sv_rate >= 0.8")
def sv_support_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filters.supported(sig(spark, sf_dir), 5, 0.8).select("svid", "chrom", "sv_type", "cluster_size", "sv_rate")


@query(cte("sig") + """, w AS (SELECT *, start // 5000 AS win FROM sig),
once AS (SELECT *, row_number() OVER (PARTITION BY chrom, sv_type, win, query_name, start, stop ORDER BY sv_len, k1, k2, k3, k4) AS d FROM w),
r AS (SELECT *, row_number() OVER (PARTITION BY chrom, sv_type, win, query_name ORDER BY start, sv_len, k1, k2, k3, k4) AS p FROM once WHERE d = 1)
SELECT chrom, sv_type, win, query_name, max(CASE WHEN p = 1 THEN maq END) AS maq, max(CASE WHEN p = 1 THEN svid END) AS svid, max(CASE WHEN p = 1 THEN seq END) AS seq,
  min(start) AS start, max(stop) AS stop, CAST(sum(sv_len) AS BIGINT) AS sv_len, count(*) AS n_signals FROM r GROUP BY ALL""")
def sv_read_collapse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clusters.read_collapse(sig(spark, sf_dir).withColumn("win", F.expr("start div 5000")), [*KEYS, "win"], K)


ADJACENT = cte("sig") + f""", l AS (SELECT *, lag(start) OVER w AS ps, lag(stop) OVER w AS pe, lag(sv_len) OVER w AS pl FROM sig WINDOW w AS ({BY})),
m AS (SELECT *, CASE WHEN ps IS NOT NULL AND abs(start - ps) <= 100 AND abs(stop - pe) <= 100 AND pl / sv_len > 0.8 AND pl / sv_len < 1.2 THEN 0 ELSE 1 END AS new FROM l),
isl AS (SELECT *, CAST(sum(new) OVER ({BY} ROWS UNBOUNDED PRECEDING) AS BIGINT) AS island FROM m)"""


@query(ADJACENT + " SELECT k1, k2, k3, k4, chrom, sv_type, island FROM isl")
def sv_adjacent_cluster(spark: SparkSession, sf_dir: str) -> DataFrame:
    return windows.adjacent(sig(spark, sf_dir), KEYS, ORDER, 100).select(*K, *KEYS, "island")


@query(ADJACENT + """, r AS (SELECT *, row_number() OVER (PARTITION BY chrom, sv_type, island ORDER BY cluster_size DESC, start, k1, k2, k3, k4) AS p FROM isl)
SELECT chrom, sv_type, island, max(CASE WHEN p = 1 THEN start END) AS start, max(CASE WHEN p = 1 THEN stop END) AS stop, max(CASE WHEN p = 1 THEN svid END) AS svid, max(CASE WHEN p = 1 THEN seq END) AS seq,
  max(sv_len) AS sv_len, CAST(floor(avg(maq)) AS INT) AS maq, CAST(sum(cluster_size) AS BIGINT) AS cluster_size, round(sum(sv_rate), 6) AS sv_rate FROM r GROUP BY chrom, sv_type, island""")
def sv_sample_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    merged = windows.adjacent(sig(spark, sf_dir), KEYS, ORDER, 100, work=lambda rows, by: clusters.sample_merge(rows, by, K))
    return merged.withColumn("sv_rate", F.round("sv_rate", 6))


def _mode(column: str) -> str:
    return f"(SELECT chrom, sv_type, island, arg_max({column}, (n, -{column})) AS {column} FROM (SELECT chrom, sv_type, island, {column}, count(*) AS n FROM isl GROUP BY ALL) GROUP BY ALL)"


@query(ADJACENT + f""", g AS (SELECT chrom, sv_type, island, CAST(floor(avg(maq)) AS INT) AS maq, count(*) AS merged FROM isl GROUP BY ALL)
SELECT g.chrom, g.sv_type, g.island, a.start, b.stop, c.sv_len, g.maq, g.merged FROM g JOIN {_mode("start")} a USING (chrom, sv_type, island) JOIN {_mode("stop")} b USING (chrom, sv_type, island) JOIN {_mode("sv_len")} c USING (chrom, sv_type, island)""")
def sv_cohort_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    return windows.adjacent(sig(spark, sf_dir), KEYS, ORDER, 100, work=lambda rows, by: clusters.cohort_merge(rows, by, ["start", "stop", "sv_len"]))


@query(cte("sig") + " SELECT chrom, start, sv_type, sv_len, svid FROM (SELECT *, row_number() OVER (PARTITION BY chrom, sv_type, start ORDER BY sv_len DESC, k1 DESC, k2 DESC, k3 DESC, k4 DESC) AS p FROM sig) WHERE p = 1")
def sv_distinct_last(spark: SparkSession, sf_dir: str) -> DataFrame:
    named = sig(spark, sf_dir).withColumn("ident", F.concat_ws(":", "chrom", "sv_type", "start"))
    return clusters.distinct_last(named, "ident", ORDER).select("chrom", "start", "sv_type", "sv_len", "svid")


@query(cte("sig") + """, l AS (SELECT *, lag(start) OVER w AS ps FROM sig WINDOW w AS (PARTITION BY chrom, sv_type ORDER BY start, sv_len, k1, k2, k3, k4)),
i AS (SELECT *, CAST(sum(CASE WHEN ps IS NOT NULL AND start < ps + 500 + CASE WHEN sv_type = 'DEL' THEN 250 ELSE 0 END THEN 0 ELSE 1 END) OVER (PARTITION BY chrom, sv_type ORDER BY start, sv_len, k1, k2, k3, k4 ROWS UNBOUNDED PRECEDING) AS BIGINT) AS island FROM l)
SELECT k1, k2, k3, k4, chrom, sv_type, island FROM i""")
def sv_gap_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    return windows.gap_windows(sig(spark, sf_dir), KEYS, ORDER).select(*K, *KEYS, "island")


@query(cte("sig") + """, w AS (SELECT *, start // 5000 AS win FROM sig), c AS (SELECT chrom, sv_type, win, quantile_cont(sv_len, 0.25) AS q1, quantile_cont(sv_len, 0.75) AS q3, count(*) AS n FROM w GROUP BY ALL),
v AS (SELECT w.chrom, w.sv_type, w.win, c.n, sv_len, sv_len >= q1 AND sv_len <= q3 AS inside, count(*) AS m FROM w JOIN c USING (chrom, sv_type, win) GROUP BY ALL)
SELECT chrom, sv_type, win, n, coalesce(arg_max(sv_len, (m, -sv_len)) FILTER (WHERE inside), arg_max(sv_len, (m, -sv_len))) AS mode_value,
 CAST(coalesce(ceil(sum(sv_len * m) FILTER (WHERE inside) / sum(m) FILTER (WHERE inside)), ceil(sum(sv_len * m) / sum(m))) AS BIGINT) AS mean_value FROM v GROUP BY chrom, sv_type, win, n""")
def sv_trimmed_mode(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clusters.trimmed(sig(spark, sf_dir).withColumn("win", F.expr("start div 5000")), [*KEYS, "win"], "sv_len")


def _anchored(width: str, widest: int) -> str:
    return cte("sig") + f""", l AS (SELECT *, lag(start) OVER w AS ps, {width} AS width FROM sig WINDOW w AS ({BY})),
i AS (SELECT *, CAST(sum(CASE WHEN ps IS NOT NULL AND start - ps < {widest} THEN 0 ELSE 1 END) OVER ({BY} ROWS UNBOUNDED PRECEDING) AS BIGINT) AS island FROM l),
o AS (SELECT *, row_number() OVER (PARTITION BY chrom, sv_type, island ORDER BY start, sv_len, k1, k2, k3, k4) AS p FROM i),
f AS (SELECT chrom, sv_type, island, p, 1::BIGINT AS win, start AS anchor, start + width AS reach FROM o WHERE p = 1
  UNION ALL SELECT o.chrom, o.sv_type, o.island, o.p, f.win + CASE WHEN o.start >= f.reach THEN 1 ELSE 0 END, CASE WHEN o.start >= f.reach THEN o.start ELSE f.anchor END, CASE WHEN o.start >= f.reach THEN o.start + o.width ELSE f.reach END
  FROM f JOIN o ON o.chrom = f.chrom AND o.sv_type = f.sv_type AND o.island = f.island AND o.p = f.p + 1),
z AS (SELECT o.*, f.win, f.anchor FROM o JOIN f USING (chrom, sv_type, island, p))"""


ADAPTIVE = _anchored("CASE WHEN sv_len < 100 THEN 200 + 0.5 * sv_len WHEN sv_len > 100 AND sv_len <= 500 THEN 400 + 0.5 * sv_len WHEN sv_len > 500 AND sv_len <= 1000 THEN 600 + 0.5 * sv_len ELSE 1500 END", 1500)


@query(ADAPTIVE + " SELECT k1, k2, k3, k4, island, win AS \"window\", anchor FROM z")
def sv_anchor_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    return windows.adaptive_windows(sig(spark, sf_dir), KEYS, ORDER).select(*K, "island", "window", "anchor")


FIXED = _anchored("500.0 + CASE WHEN sv_type = 'DEL' THEN 250 ELSE 0 END", 750)


@query(FIXED + " SELECT k1, k2, k3, k4, island, win AS \"window\", anchor FROM z")
def sv_fixed_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    return windows.fixed_windows(sig(spark, sf_dir), KEYS, ORDER).select(*K, "island", "window", "anchor")


@query(ADAPTIVE + """, s AS (SELECT chrom, sv_type, island, win, count(DISTINCT query_name) AS reads, max(sv_len) AS longest FROM z GROUP BY ALL)
SELECT z.k1, z.k2, z.k3, z.k4, s.reads FROM z JOIN s USING (chrom, sv_type, island, win) WHERE (reads >= 3 AND reads < 60) OR (z.sv_type = 'INS' AND longest >= 5000)""")
def sv_window_keep(spark: SparkSession, sf_dir: str) -> DataFrame:
    return windows.kept_windows(windows.adaptive_windows(sig(spark, sf_dir), KEYS, ORDER), KEYS, 6.0).select(*K, "reads")


@query(FIXED + """, s AS (SELECT chrom, sv_type, island, win, count(DISTINCT query_name) AS reads FROM z GROUP BY ALL)
SELECT z.k1, z.k2, z.k3, z.k4, s.reads FROM z JOIN s USING (chrom, sv_type, island, win) WHERE reads >= 2 AND reads < 4""")
def sv_fixed_window_keep(spark: SparkSession, sf_dir: str) -> DataFrame:
    return windows.kept_fixed_windows(windows.fixed_windows(sig(spark, sf_dir), KEYS, ORDER), KEYS, 0.04).select(*K, "reads")


@query(ADAPTIVE + """, s AS (SELECT chrom, sv_type, island, win, count(DISTINCT query_name) AS reads, max(sv_len) AS longest FROM z GROUP BY ALL)
SELECT z.k1, z.k2, z.k3, z.k4, s.reads, reads >= 1 AND reads < 20 OR (z.sv_type = 'INS' AND longest >= 5000) AS few, reads >= 3 AND reads < 20 OR (z.sv_type = 'INS' AND longest >= 5000) AS many FROM z JOIN s USING (chrom, sv_type, island, win)
 WHERE reads >= 1 AND reads < 20 OR (z.sv_type = 'INS' AND longest >= 5000)""")
def sv_break_window_keep(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Windows kept where clip ends confirm candidates, by either number of reads asked for."""
    marked = windows.adaptive_windows(sig(spark, sf_dir), KEYS, ORDER)
    few, many = (windows.kept_break_windows(marked, KEYS, 2.0, n) for n in (5, 6))
    both = few.select(*K, "reads").join(many.select(*K, F.lit(True).alias("many")), K, "left")
    return both.select(*K, "reads", F.lit(True).alias("few"), F.coalesce("many", F.lit(False)).alias("many"))


@query(cte("sig") + """, t AS (SELECT chrom, sv_type, start, stop, sv_len AS target_size, k1, k2, k3, k4 FROM sig),
l AS (SELECT *, lag(start) OVER w AS ps FROM t WINDOW w AS (PARTITION BY chrom, sv_type ORDER BY start, stop, target_size)),
i AS (SELECT *, sum(CASE WHEN ps IS NOT NULL AND start - ps < 800 THEN 0 ELSE 1 END) OVER (PARTITION BY chrom, sv_type ORDER BY start, stop, target_size ROWS UNBOUNDED PRECEDING) AS island FROM l),
o AS (SELECT *, row_number() OVER (PARTITION BY chrom, sv_type, island ORDER BY start, stop, target_size) AS p FROM i),
f AS (SELECT chrom, sv_type, island, p, 1 AS win, start AS anchor FROM o WHERE p = 1
  UNION ALL SELECT o.chrom, o.sv_type, o.island, o.p, f.win + CASE WHEN o.start >= f.anchor + 800 THEN 1 ELSE 0 END, CASE WHEN o.start >= f.anchor + 800 THEN o.start ELSE f.anchor END FROM f JOIN o ON o.chrom = f.chrom AND o.sv_type = f.sv_type AND o.island = f.island AND o.p = f.p + 1)
SELECT chrom, sv_type, min(o.start) AS start, arg_min(o.stop, (o.start, o.stop, o.target_size)) AS stop, CAST(sum(target_size) AS BIGINT) AS target_size, count(*) AS merged FROM o JOIN f USING (chrom, sv_type, island, p) GROUP BY chrom, sv_type, island, win""")
def sv_merge_close(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = sig(spark, sf_dir).select("chrom", "sv_type", "start", "stop", F.col("sv_len").alias("target_size"))
    return windows.merge_close(table)


HIGH = "CASE WHEN {l} <= 100 THEN 50 + ceil(0.8 * ({l} - 50)) WHEN {l} <= 500 THEN 100 + ceil(0.8 * ({l} - 100)) WHEN {l} <= 5000 THEN 450 + ceil(0.1 * ({l} - 500)) ELSE 1000 END"
LOOKBACK = ADAPTIVE + f""", b AS (SELECT *, row_number() OVER (PARTITION BY chrom, sv_type, island, win ORDER BY start, sv_len, k1, k2, k3, k4) - 1 AS j, count(*) OVER (PARTITION BY chrom, sv_type, island, win) AS n FROM z),
par AS (SELECT a.chrom, a.sv_type, a.island, a.win, a.j, coalesce(max(c.j), a.j) AS up FROM b a LEFT JOIN b c ON a.chrom = c.chrom AND a.sv_type = c.sv_type AND a.island = c.island AND a.win = c.win AND c.j < a.j AND c.j >= a.j - ceil(0.8 * a.n)
  AND least(a.sv_len / c.sv_len, c.sv_len / a.sv_len) > 0.8 AND (abs(a.start - c.start) <= {HIGH.format(l="c.sv_len")} OR abs(a.stop - c.stop) <= {HIGH.format(l="c.sv_len")}) GROUP BY a.chrom, a.sv_type, a.island, a.win, a.j),
root AS (SELECT chrom, sv_type, island, win, j, up AS r FROM par WHERE up = j UNION ALL SELECT p.chrom, p.sv_type, p.island, p.win, p.j, root.r FROM par p JOIN root ON p.chrom = root.chrom AND p.sv_type = root.sv_type AND p.island = root.island AND p.win = root.win AND p.up = root.j WHERE p.up <> p.j),
cl AS (SELECT b.*, CASE WHEN count(*) OVER (PARTITION BY b.chrom, b.sv_type, b.island, b.win, root.r) = 1 THEN -1 ELSE root.r END AS cluster FROM b JOIN root USING (chrom, sv_type, island, win, j))"""


def _looked_back(spark: SparkSession, sf_dir: str, *more: str) -> DataFrame:
    """Clusters of signals with what makes them and more columns; others need not go to the workers."""
    rows = sig(spark, sf_dir).select(*K, *KEYS, "start", "stop", "sv_len", *more)
    win = windows.adaptive_windows(rows, KEYS, ORDER).drop("anchor")
    return lookback.look_back(win, [*KEYS, "island", "window"], ORDER, "high")


@query(LOOKBACK + " SELECT k1, k2, k3, k4, cluster FROM cl")
def sv_lookback_cluster(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _looked_back(spark, sf_dir).select(*K, "cluster")


@query(LOOKBACK + """, s AS (SELECT chrom, sv_type, island, win, cluster, count(*) AS cluster_size, min(start) AS first_start FROM cl GROUP BY ALL),
r AS (SELECT *, CAST(sum(cluster_size) OVER (PARTITION BY chrom, sv_type, island, win) AS BIGINT) AS total, row_number() OVER (PARTITION BY chrom, sv_type, island, win ORDER BY cluster_size DESC, first_start, cluster) AS rank FROM s)
SELECT chrom, sv_type, island, win AS "window", cluster, cluster_size, first_start, total, CAST(rank AS INT) AS rank FROM r WHERE rank <= 2""")
def sv_top_alleles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clusters.top_alleles(_looked_back(spark, sf_dir), [*KEYS, "island", "window"])


def _modes(column: str) -> str:
    keys = "chrom, sv_type, island, win, cluster"
    return f"""(SELECT {keys}, coalesce(arg_max({column}, (m, -{column})) FILTER (WHERE {column} >= q1 AND {column} <= q3), arg_max({column}, (m, -{column}))) AS {column}
 FROM (SELECT {keys}, q1, q3, {column}, count(*) AS m FROM cl JOIN (SELECT {keys}, quantile_cont({column}, 0.25) AS q1, quantile_cont({column}, 0.75) AS q3 FROM cl GROUP BY ALL) USING ({keys}) GROUP BY ALL) GROUP BY {keys})"""


@query(LOOKBACK + f""", g AS (SELECT chrom, sv_type, island, win, cluster, max(stop) AS stop, count(DISTINCT query_name) AS reads FROM cl GROUP BY ALL)
SELECT g.chrom, g.sv_type, g.island, g.win AS "window", g.cluster, a.start, g.stop, c.sv_len, g.reads, d.maq FROM g JOIN {_modes("start")} a USING (chrom, sv_type, island, win, cluster) JOIN {_modes("sv_len")} c USING (chrom, sv_type, island, win, cluster) JOIN {_modes("maq")} d USING (chrom, sv_type, island, win, cluster)""")
def sv_cluster_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clusters.cluster_stats(_looked_back(spark, sf_dir, "query_name", "maq"), [*KEYS, "island", "window", "cluster"]).drop("reads_id")


@query(cte("sig") + """, o AS (SELECT *, row_number() OVER (PARTITION BY chrom, query_name ORDER BY start, sv_len DESC, k1, k2, k3, k4) AS p FROM sig),
f AS (SELECT chrom, query_name, p, svid AS kept, stop AS last, 1 AS slot FROM o WHERE p = 1
  UNION ALL SELECT o.chrom, o.query_name, o.p, CASE WHEN o.start > f.last OR o.stop > f.last THEN o.svid ELSE f.kept END, greatest(o.stop, f.last), f.slot + CASE WHEN o.start > f.last THEN 1 ELSE 0 END FROM f JOIN o ON o.chrom = f.chrom AND o.query_name = f.query_name AND o.p = f.p + 1)
SELECT chrom, query_name, arg_max(kept, p) AS svid FROM f GROUP BY chrom, query_name, slot""")
def sv_overlap_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clusters.overlap_filter(sig(spark, sf_dir), ["chrom", "query_name"], K).select("chrom", "query_name", "svid")


@query(cte("sig") + """, o AS (SELECT *, CASE WHEN lag(query_name) OVER w = query_name THEN 0 ELSE 1 END AS new FROM sig WINDOW w AS (PARTITION BY chrom, sv_type ORDER BY start, sv_len, k1, k2, k3, k4)),
r AS (SELECT *, CAST(sum(new) OVER (PARTITION BY chrom, sv_type ORDER BY start, sv_len, k1, k2, k3, k4 ROWS UNBOUNDED PRECEDING) AS BIGINT) AS run FROM o)
SELECT chrom, sv_type, run, query_name, min(start) AS start, max(stop) AS stop, CAST(sum(sv_len) AS BIGINT) AS sv_len, count(*) AS n_signals FROM r GROUP BY ALL""")
def sv_run_collapse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clusters.run_collapse(sig(spark, sf_dir), KEYS, ORDER)


@query(cte("sig", "cov") + """, s AS (SELECT DISTINCT k1, k2, k3, k4, chrom, start, stop FROM sig)
SELECT s.k1, s.k2, s.k3, s.k4, s.start, s.stop, count(cov.read_id) AS n FROM s LEFT JOIN cov ON s.chrom = cov.chrom AND s.start <= cov.stop AND s.stop >= cov.start GROUP BY ALL""")
def sv_local_depth(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = sig(spark, sf_dir).select(*K, "chrom", "start", "stop").distinct()
    return intervals.count_overlaps(rows, spark_table(spark, sf_dir, "cov"), [*K, "start", "stop"]).select(*K, "start", "stop", "n")


@query(cte("sig", "cov") + """, s AS (SELECT DISTINCT k1, k2, k3, k4, chrom, start, stop FROM sig)
SELECT s.k1, s.k2, s.k3, s.k4, s.start, s.stop, count(cov.read_id) AS n FROM s LEFT JOIN cov ON s.chrom = cov.chrom AND cov.start <= s.start AND cov.stop >= s.stop GROUP BY ALL""")
def sv_containing_depth(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = sig(spark, sf_dir).select(*K, "chrom", "start", "stop").distinct()
    return intervals.count_covering(rows, spark_table(spark, sf_dir, "cov"), [*K, "start", "stop"]).select(*K, "start", "stop", "n")


@query(cte("sig", "cov") + """, s AS (SELECT *, CASE WHEN sv_type IN ('INS', 'DUP') THEN start - 70 ELSE CAST(floor(start + 0.5 * sv_len) AS BIGINT) END AS low, CASE WHEN sv_type IN ('INS', 'DUP') THEN start - 50 ELSE CAST(floor(start + 0.5 * sv_len) AS BIGINT) + 20 END AS high FROM sig),
d AS (SELECT s.k1, s.k2, s.k3, s.k4, s.sv_type, s.sv_len, s.cluster_size AS reads, count(cov.read_id) AS depth FROM s LEFT JOIN cov ON s.chrom = cov.chrom AND s.low <= cov.stop AND s.high >= cov.start GROUP BY ALL),
a AS (SELECT *, reads >= (depth + 1) * 0.4 + 1 AS main, (sv_type = 'INS' AND sv_len > 3000 AND reads >= (depth + 1) * 0.4 * 0.6) OR (sv_type = 'DUP' AND sv_len > 500 AND reads >= (depth + 1) * 0.4 * 0.5) OR (sv_type = 'INV' AND reads >= (depth + 1) * 0.4 * 0.5) AS rescue FROM d)
SELECT k1, k2, k3, k4, depth, CASE WHEN main THEN 'main' ELSE 'rescue' END AS accepted, half_even(reads / (depth + 1), 2) AS sv_rate FROM a WHERE reads >= 2 AND (main OR rescue)""")
def sv_depth_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    low, high = clusters.probe_places(F.col("sv_type"), F.col("start"), F.col("sv_len"))
    probes = sig(spark, sf_dir).withColumns({"low": low, "high": high, "reads": F.col("cluster_size")})
    counted = intervals.count_overlaps(probes, spark_table(spark, sf_dir, "cov"), K, "depth", None, ("chrom", "low", "high"))
    return clusters.accept(counted, 0.4).select(*K, "depth", "accepted", "sv_rate")


WINDOW_ONE = ", ".join(("chrom", "sv_type", "island", "win"))
CANDIDATES = ADAPTIVE + f""", ws AS (SELECT {WINDOW_ONE}, count(DISTINCT query_name) AS reads, max(sv_len) AS longest FROM z GROUP BY ALL),
kz AS (SELECT z.* FROM z JOIN ws USING ({WINDOW_ONE}) WHERE (reads >= 3 AND reads < 60) OR (z.sv_type = 'INS' AND longest >= 5000)),
once AS (SELECT *, row_number() OVER (PARTITION BY {WINDOW_ONE}, query_name, start, stop ORDER BY sv_len, k1, k2, k3, k4) AS d FROM kz),
rr AS (SELECT *, row_number() OVER (PARTITION BY {WINDOW_ONE}, query_name ORDER BY start, sv_len, k1, k2, k3, k4) AS pp FROM once WHERE d = 1),
one AS (SELECT {WINDOW_ONE}, query_name, max(CASE WHEN pp = 1 THEN maq END) AS maq, max(CASE WHEN pp = 1 THEN svid END) AS svid, min(start) AS start, max(stop) AS stop, CAST(sum(sv_len) AS BIGINT) AS sv_len FROM rr GROUP BY {WINDOW_ONE}, query_name)""" \
    + LOOKBACK[len(ADAPTIVE):].replace("ORDER BY start, sv_len, k1, k2, k3, k4) - 1 AS j", "ORDER BY start, sv_len, svid) - 1 AS j").replace("FROM z)", "FROM one)") + f""",
sz AS (SELECT {WINDOW_ONE}, cluster, count(*) AS cluster_size, min(start) AS first_start FROM cl GROUP BY ALL),
rk AS (SELECT *, sum(cluster_size) OVER w AS total, max(cluster_size) OVER w AS top, row_number() OVER (PARTITION BY {WINDOW_ONE} ORDER BY cluster_size DESC, first_start, cluster) AS rank FROM sz WINDOW w AS (PARTITION BY {WINDOW_ONE})),
ct AS (SELECT cl.* FROM cl JOIN rk USING ({WINDOW_ONE}, cluster) WHERE rank <= 2 AND top / total >= 0.05),
g AS (SELECT {WINDOW_ONE}, cluster, max(stop) AS stop, count(DISTINCT query_name) AS reads FROM ct GROUP BY ALL),
st AS (SELECT g.*, a.start, c.sv_len, m.maq FROM g JOIN {_modes("start").replace("FROM cl ", "FROM ct ")} a USING ({WINDOW_ONE}, cluster) JOIN {_modes("sv_len").replace("FROM cl ", "FROM ct ")} c USING ({WINDOW_ONE}, cluster) JOIN {_modes("maq").replace("FROM cl ", "FROM ct ")} m USING ({WINDOW_ONE}, cluster)),
pr AS (SELECT *, CASE WHEN sv_type IN ('INS', 'DUP') THEN start - 70 ELSE CAST(floor(start + 0.5 * sv_len) AS BIGINT) END AS low, CASE WHEN sv_type IN ('INS', 'DUP') THEN start - 50 ELSE CAST(floor(start + 0.5 * sv_len) AS BIGINT) + 20 END AS high FROM st),
dp AS (SELECT {", ".join("pr." + c for c in ("chrom", "sv_type", "island", "win", "cluster", "start", "stop", "sv_len", "maq", "reads"))}, count(cov.read_id) AS depth FROM pr LEFT JOIN cov ON pr.chrom = cov.chrom AND pr.low <= cov.stop AND pr.high >= cov.start GROUP BY ALL),
ac AS (SELECT *, reads >= (depth + 1) * 0.1 + 1 AS main, (sv_type = 'INS' AND sv_len > 3000 AND reads >= (depth + 1) * 0.1 * 0.6) OR (sv_type = 'DUP' AND sv_len > 500 AND reads >= (depth + 1) * 0.1 * 0.5) OR (sv_type = 'INV' AND reads >= (depth + 1) * 0.1 * 0.5) AS rescue FROM dp)
SELECT chrom, sv_type, start, stop, sv_len, maq, reads, depth, CASE WHEN main THEN 'main' ELSE 'rescue' END AS accepted, half_even(reads / (depth + 1), 2) AS sv_rate FROM ac WHERE reads >= 2 AND (main OR rescue)"""


@query(CANDIDATES.replace(cte("sig"), cte("sig", "cov"), 1))
def sv_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Signals to accepted candidates, end to end: windows, those of enough reads, one row a read, clusters by looking
    back, the two largest of a window, trimmed statistics, depth at the breakpoint, acceptance."""
    window = [*KEYS, "island", "window"]
    rows = sig(spark, sf_dir).select(*K, *KEYS, "query_name", "start", "stop", "sv_len", "maq", "svid", "seq")
    kept = windows.kept_windows(windows.adaptive_windows(rows, KEYS, ORDER).drop("anchor"), KEYS, 6.0).drop("reads")
    # clusters, and then their statistics, are read several times and worked out once
    clustered = runs.settled(lookback.look_back(clusters.read_collapse(kept, window, K).drop("seq", "n_signals"), window, ["sv_len", "svid"], "high").drop("svid"))
    largest = clusters.top_alleles(clustered, window).select(*window, "cluster")
    stats = clusters.cluster_stats(clustered.join(largest, [*window, "cluster"], "left_semi"), [*window, "cluster"]).drop("reads_id")
    low, high = clusters.probe_places(F.col("sv_type"), F.col("start"), F.col("sv_len"))
    probes = runs.settled(stats.withColumns({"low": low, "high": high}))
    counted = intervals.count_overlaps(probes, spark_table(spark, sf_dir, "cov"), [*window, "cluster"], "depth", None, ("chrom", "low", "high"))
    return clusters.accept(counted, 0.1).select("chrom", "sv_type", "start", "stop", "sv_len", "maq", "reads", "depth", "accepted", "sv_rate")


@query(cte("sig") + """, drop_ AS (SELECT DISTINCT i.svid FROM sig i JOIN sig d ON i.sv_type = 'INS' AND d.sv_type = 'DUP' AND i.chrom = d.chrom AND i.start > d.start - 500 AND i.start < d.stop + 500 AND d.start < i.start - 50 AND i.start - 50 < d.stop AND least(i.sv_len / d.sv_len, d.sv_len / i.sv_len) >= 0.8)
SELECT svid, chrom, sv_type, start, sv_len FROM sig WHERE svid NOT IN (SELECT svid FROM drop_)""")
def sv_drop_ins_in_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return intervals.insertions_in_duplications(sig(spark, sf_dir)).select("svid", "chrom", "sv_type", "start", "sv_len")


@query(cte("sig", "cov") + """, p AS (SELECT DISTINCT chrom, start AS pos FROM sig)
SELECT p.chrom, p.pos, count(cov.read_id) AS break_n FROM p LEFT JOIN cov ON p.chrom = cov.chrom AND cov.start BETWEEN p.pos - 100 AND p.pos + 100 GROUP BY ALL""")
def sv_breakpoint_support(spark: SparkSession, sf_dir: str) -> DataFrame:
    points = sig(spark, sf_dir).select("chrom", F.col("start").alias("pos")).distinct()
    ends = spark_table(spark, sf_dir, "cov").select("chrom", F.col("start").alias("pos"))
    return intervals.nearest_breakpoints(points, ends, ["chrom", "pos"])


@query(cte("cov") + """, z AS (SELECT chrom, CAST(4000000 AS BIGINT) AS size, CAST(sum(stop - start) AS BIGINT) AS mapped FROM cov GROUP BY chrom)
SELECT chrom, size, mapped, half_even(mapped / size, 2) AS depth, CAST(ceil(half_even(mapped / size, 2) + 0.3) AS BIGINT) AS threshold, CAST(floor(half_even(mapped / size, 2) / 10) AS BIGINT) AS nreads FROM z""")
def sv_mean_depth(spark: SparkSession, sf_dir: str) -> DataFrame:
    cov = spark_table(spark, sf_dir, "cov")
    sizes = cov.select("chrom").distinct().withColumn("size", F.lit(4000000).cast("long"))
    return clusters.mean_depth(cov, sizes)


TRA = cte("sig") + """, t AS (SELECT k1, k2, k3, k4, chrom, concat('Chr', CAST(k3 % 3 + 1 AS VARCHAR)) AS chrom2, start * 10 AS start, k1 * 40 % 90000 AS start2 FROM sig)"""


def _translocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sig(spark, sf_dir).select(*K, "chrom", F.concat(F.lit("Chr"), (F.col("k3") % 3 + 1).cast("string")).alias("chrom2"), (F.col("start") * 10).alias("start"), (F.col("k1") * 40 % 90000).alias("start2"))


@query(TRA + """, l AS (SELECT *, lag(start) OVER w AS a, lag(start2) OVER w AS b FROM t WINDOW w AS (PARTITION BY chrom, chrom2 ORDER BY start, start2, k1, k2, k3, k4))
SELECT k1, k2, k3, k4, CAST(sum(CASE WHEN a IS NOT NULL AND abs(start - a) <= 20000 AND abs(start2 - b) <= 20000 THEN 0 ELSE 1 END) OVER (PARTITION BY chrom, chrom2 ORDER BY start, start2, k1, k2, k3, k4 ROWS UNBOUNDED PRECEDING) AS BIGINT) AS island FROM l""")
def tra_adjacent_cluster(spark: SparkSession, sf_dir: str) -> DataFrame:
    return windows.adjacent_pairs(_translocations(spark, sf_dir), K, 10000).select(*K, "island")


@query(TRA + """, w AS (SELECT *, start // 200000 AS win, row_number() OVER (PARTITION BY chrom, chrom2, start // 200000 ORDER BY start, start2, k1, k2, k3, k4) - 1 AS j FROM t),
par AS (SELECT a.chrom, a.chrom2, a.win, a.j, coalesce(max(c.j), a.j) AS up FROM w a LEFT JOIN w c ON a.chrom = c.chrom AND a.chrom2 = c.chrom2 AND a.win = c.win AND c.j < a.j AND c.j >= a.j - 40 AND abs(a.start - c.start) <= 1000 AND abs(a.start2 - c.start2) <= 1000 GROUP BY a.chrom, a.chrom2, a.win, a.j),
root AS (SELECT chrom, chrom2, win, j, up AS r FROM par WHERE up = j UNION ALL SELECT p.chrom, p.chrom2, p.win, p.j, root.r FROM par p JOIN root ON p.chrom = root.chrom AND p.chrom2 = root.chrom2 AND p.win = root.win AND p.up = root.j WHERE p.up <> p.j)
SELECT k1, k2, k3, k4, CASE WHEN count(*) OVER (PARTITION BY w.chrom, w.chrom2, w.win, r) = 1 THEN -1 ELSE r END AS cluster FROM w JOIN root USING (chrom, chrom2, win, j)""")
def tra_lookback_cluster(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _translocations(spark, sf_dir).withColumn("win", F.expr("start div 200000"))
    return lookback.look_back_pairs(rows, ["chrom", "chrom2", "win"], K).select(*K, "cluster")


COHORT = ADJACENT.replace("WINDOW w AS", "WHERE sv_type = 'DEL' AND sv_len >= 100 AND maq >= 30 WINDOW w AS") + """, r AS (SELECT *, row_number() OVER (PARTITION BY chrom, sv_type, island ORDER BY cluster_size DESC, start, k1, k2, k3, k4) AS p FROM isl),
mm AS (SELECT chrom, sv_type, island, max(CASE WHEN p = 1 THEN start END) AS start, max(CASE WHEN p = 1 THEN stop END) AS stop, max(sv_len) AS sv_len, CAST(sum(cluster_size) AS BIGINT) AS cluster_size, avg(sv_rate) AS sv_rate FROM r GROUP BY chrom, sv_type, island)
SELECT chrom, start, stop, sv_len AS target_size, -sv_len AS query_size, CASE WHEN sv_rate > 0.65 THEN '1/1' WHEN sv_rate < 0.1 THEN '0/0' ELSE '0/1' END AS gt, cluster_size FROM mm"""


@query(COHORT)
def cohort_deletions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flagship: filtered deletions, clustered, merged and genotyped from their rates."""
    kept = filters.signal_sizes(sig(spark, sf_dir).where("sv_type = 'DEL'"), 100, 10_000_000, 30)
    work = lambda rows, by: clusters.sample_merge(rows, by, K, more=(F.avg("sv_rate").alias("mean_rate"),))
    merged = windows.adjacent(kept, KEYS, ORDER, 100, work=work).withColumn("sv_rate", F.col("mean_rate"))
    return genotypes.from_signal_rate(merged, "s1", ("cluster_size",)).select("chrom", "start", "stop", "target_size", "query_size", "gt", "cluster_size")
