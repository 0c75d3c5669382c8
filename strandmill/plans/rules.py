"""Queries on the remaining filters, acceptance and genotype rules, and genotyping from reads."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandmill.functions import scalars
from strandmill.operators import alignments, clusters, cohort, filters, genotypes, windows
from strandmill.plans.catalog import query
from strandmill.plans.cohorts import OPS, align, pieces, ratios
from strandmill.plans.projection import cte, spark_table
from strandmill.plans.signals import K, sig

C = F.col


@query(cte("align") + " SELECT qname, flag, mapq FROM align WHERE flag <> 4 AND mapq >= 40")
def assembly_reads(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filters.signal_reads(align(spark, sf_dir), 40, assembly=True).select("qname", "flag", "mapq")


@query(cte("align") + " SELECT qname, flag, mapq FROM align WHERE (flag & 4) = 0 AND mapq >= 25")
def genotype_reads(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filters.genotype_reads(align(spark, sf_dir), 25).select("qname", "flag", "mapq")


@query(OPS + " SELECT qname FROM pl GROUP BY qname HAVING max(CASE WHEN op IN ('H', 'S') THEN n ELSE 0 END) <= 700")
def long_clips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filters.long_operations(align(spark, sf_dir), 700, only_clips=True).select("qname")


@query(OPS + " SELECT qname FROM pl GROUP BY qname HAVING max(n) <= 700")
def long_operations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filters.long_operations(align(spark, sf_dir), 700).select("qname")


@query(cte("sig") + " SELECT svid, chrom, sv_type, sv_len FROM sig WHERE sv_type <> 'INV' OR chrom = 'Chr5' OR sv_len < CAST(right(chrom, 1) AS INT) * 700 / 4")
def sv_inversion_guard(spark: SparkSession, sf_dir: str) -> DataFrame:
    sizes = spark.createDataFrame([(f"Chr{k}", 700 * k) for k in range(1, 5)], "chrom string, size long")
    return filters.inversion_guard(sig(spark, sf_dir), sizes).select("svid", "chrom", "sv_type", "sv_len")


@query(cte("piece") + """, p AS (SELECT DISTINCT qname, flag, chrom, start, stop, cl, cm, cr, mapq FROM piece), n AS (SELECT *, count(*) OVER w AS n, count(CASE WHEN flag <= 16 THEN 1 END) OVER w AS primary_n FROM p WINDOW w AS (PARTITION BY qname))
SELECT qname, flag, chrom, start, stop FROM n WHERE n BETWEEN 2 AND 20 AND primary_n > 0""")
def segment_reads(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filters.segment_reads(pieces(spark, sf_dir)).select("qname", "flag", "chrom", "start", "stop")


@query(cte("ratio") + " SELECT k1, k2, k3, k4, a AS maf, size FROM ratio WHERE a BETWEEN 0.05 AND 0.95 AND abs(size) BETWEEN 50 AND 500")
def marker_sites(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filters.marker_sites(ratios(spark, sf_dir).withColumnRenamed("a", "maf")).select(*K, "maf", "size")


@query(cte("snp") + " SELECT chrom, pos, con, mut FROM snp WHERE pos > 1500 AND pos < 3000 + 100 * CAST(right(chrom, 1) AS INT) - 1500")
def snp_sites(spark: SparkSession, sf_dir: str) -> DataFrame:
    sizes = spark.createDataFrame([(f"c{k}", 3000 + 100 * k) for k in range(4)], "chrom string, size long")
    return filters.snp_sites(spark_table(spark, sf_dir, "snp"), sizes, 1500).select("chrom", "pos", "con", "mut")


@query(cte("sig") + " SELECT svid, concat('<', sv_type, '>') AS alt FROM sig WHERE sv_type IN ('DEL', 'INS')")
def vcf_indels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filters.indels(sig(spark, sf_dir).select("svid", F.concat(F.lit("<"), "sv_type", F.lit(">")).alias("alt")))


@query(cte("gene") + " SELECT gene, CASE WHEN strand = '+' THEN 'CDS' ELSE 'mRNA' END AS feature, start, stop - 1900 AS stop FROM gene WHERE strand <> '+' OR start < stop - 1900")
def sane_cds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filters.sane_cds(spark_table(spark, sf_dir, "gene").select("gene", F.when(C("strand") == "+", "CDS").otherwise("mRNA").alias("feature"), "start", (C("stop") - 1900).alias("stop")))


@query(cte("sig") + """, o AS (SELECT *, row_number() OVER (PARTITION BY chrom, sv_type, query_name ORDER BY start, sv_len DESC, k1, k2, k3, k4) AS p FROM sig),
f AS (SELECT chrom, sv_type, query_name, p, svid AS kept, stop AS last, 1 AS slot FROM o WHERE p = 1
  UNION ALL SELECT o.chrom, o.sv_type, o.query_name, o.p, CASE WHEN o.start > f.last OR o.stop > f.last THEN o.svid ELSE f.kept END, greatest(o.stop, f.last), f.slot + CASE WHEN o.start > f.last THEN 1 ELSE 0 END FROM f JOIN o ON o.chrom = f.chrom AND o.sv_type = f.sv_type AND o.query_name = f.query_name AND o.p = f.p + 1),
k AS (SELECT chrom, sv_type, query_name, arg_max(kept, p) AS svid FROM f GROUP BY chrom, sv_type, query_name, slot)
SELECT chrom, sv_type, query_name, min(start) AS start, max(stop) AS stop, CAST(sum(sv_len) AS BIGINT) AS sv_len, max(maq) AS maq, count(*) AS n_signals FROM sig JOIN k USING (chrom, sv_type, query_name, svid) GROUP BY chrom, sv_type, query_name""")
def sv_query_collapse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clusters.query_collapse(sig(spark, sf_dir), ["chrom", "sv_type"], K)


PAIRED = cte("sig") + """, t AS (SELECT k1, k2, k3, k4, chrom, concat('Chr', CAST(k3 % 3 + 1 AS VARCHAR)) AS chrom2, start * 10 AS start, k1 * 40 % 90000 AS start2, svid, seq, maq, sv_len, cluster_size, sv_rate FROM sig),
l AS (SELECT *, lag(start) OVER w AS a, lag(start2) OVER w AS b FROM t WINDOW w AS (PARTITION BY chrom, chrom2 ORDER BY start, start2, k1, k2, k3, k4)),
i AS (SELECT *, CAST(sum(CASE WHEN a IS NOT NULL AND abs(start - a) <= 20000 AND abs(start2 - b) <= 20000 THEN 0 ELSE 1 END) OVER (PARTITION BY chrom, chrom2 ORDER BY start, start2, k1, k2, k3, k4 ROWS UNBOUNDED PRECEDING) AS BIGINT) AS island FROM l)"""


def paired(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sig(spark, sf_dir).withColumns({"chrom2": F.concat(F.lit("Chr"), (C("k3") % 3 + 1).cast("string")), "start": C("start") * 10, "start2": C("k1") * 40 % 90000})


@query(PAIRED + """, r AS (SELECT *, row_number() OVER (PARTITION BY chrom, chrom2, island ORDER BY cluster_size DESC, start, k1, k2, k3, k4) AS p FROM i)
SELECT chrom, chrom2, island, max(CASE WHEN p = 1 THEN start END) AS start, max(CASE WHEN p = 1 THEN start2 END) AS start2, max(CASE WHEN p = 1 THEN svid END) AS svid, CAST(0 AS BIGINT) AS sv_len, CAST(floor(avg(maq)) AS INT) AS maq, CAST(sum(cluster_size) AS BIGINT) AS cluster_size, round(sum(sv_rate), 6) AS sv_rate
FROM r GROUP BY chrom, chrom2, island""")
def tra_sample_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    merged = windows.adjacent_pairs(paired(spark, sf_dir).drop("stop", "seq"), K, 10000, lambda rows, by: clusters.sample_merge(rows, by, K, translocations=True))
    return merged.withColumn("sv_rate", F.round("sv_rate", 6))


@query(cte("sig") + """, t AS (SELECT k1, k2, k3, k4, chrom, concat('Chr', CAST(k3 % 3 + 1 AS VARCHAR)) AS chrom2, start * 10 AS start FROM sig),
l AS (SELECT *, lag(start) OVER w AS ps FROM t WINDOW w AS (PARTITION BY chrom, chrom2 ORDER BY start, k1, k2, k3, k4)),
i AS (SELECT *, CAST(sum(CASE WHEN ps IS NOT NULL AND start - ps < 18000 THEN 0 ELSE 1 END) OVER (PARTITION BY chrom, chrom2 ORDER BY start, k1, k2, k3, k4 ROWS UNBOUNDED PRECEDING) AS BIGINT) AS island FROM l),
o AS (SELECT *, row_number() OVER (PARTITION BY chrom, chrom2, island ORDER BY start, k1, k2, k3, k4) AS p FROM i),
f AS (SELECT chrom, chrom2, island, p, 1::BIGINT AS win, start AS anchor FROM o WHERE p = 1
  UNION ALL SELECT o.chrom, o.chrom2, o.island, o.p, f.win + CASE WHEN o.start >= f.anchor + 18000 THEN 1 ELSE 0 END, CASE WHEN o.start >= f.anchor + 18000 THEN o.start ELSE f.anchor END FROM f JOIN o ON o.chrom = f.chrom AND o.chrom2 = f.chrom2 AND o.island = f.island AND o.p = f.p + 1)
SELECT o.k1, o.k2, o.k3, o.k4, o.island, f.win AS "window", f.anchor FROM o JOIN f USING (chrom, chrom2, island, p)""")
def tra_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    return windows.translocation_windows(paired(spark, sf_dir), ["chrom", "chrom2"], K, 18000).select(*K, "island", "window", "anchor")


@query(cte("align") + " SELECT rname, sample, count(CASE WHEN (flag & 4) = 0 THEN 1 END) AS reads, CAST(coalesce(ceil(sum(CASE WHEN (flag & 4) = 0 THEN mapq END) / count(CASE WHEN (flag & 4) = 0 THEN 1 END)), 0) AS BIGINT) AS maq FROM align GROUP BY ALL")
def mean_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clusters.mean_quality(align(spark, sf_dir), ["rname", "sample"])


ENDS = OPS + """, rd AS (SELECT qname, rname, pos, pos + CAST(sum(CASE WHEN op IN ('M', 'D', 'N', '=', 'X') THEN n ELSE 0 END) AS BIGINT) AS stop, bool_or(i = 1 AND op IN ('S', 'H')) AS cut_l, bool_or(i = k AND op IN ('S', 'H')) AS cut_r
 FROM (SELECT *, count(*) OVER (PARTITION BY qname) AS k FROM pl) GROUP BY qname, rname, pos)"""


@query(ENDS + " SELECT rname AS chrom, spot AS pos, count(*) AS n FROM (SELECT rname, pos AS spot FROM rd WHERE cut_l UNION ALL SELECT rname, stop FROM rd WHERE cut_r) GROUP BY ALL")
def breakpoint_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignments.breakpoint_histogram(align(spark, sf_dir))


PROBED = cte("sig", "ratio") + ", q AS (SELECT s.k1, s.k2, s.k3, s.k4, s.sv_type, s.sv_len * 7 AS sv_len, s.cluster_size AS reads, r.depth, r.depth + r.spans AS left_n, r.support AS right_n, r.spans AS break1_n, r.support % 3 AS break2_n FROM sig s JOIN ratio r USING (k1, k2, k3, k4))"


def probed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Candidates with made-up depths: sizes to 7280, so that every rescue can occur."""
    rows = ratios(spark, sf_dir).select(*K, "depth", (C("depth") + C("spans")).alias("left_n"), C("support").alias("right_n"), C("spans").alias("break1_n"), (C("support") % 3).alias("break2_n"))
    return sig(spark, sf_dir).select(*K, "sv_type", (C("sv_len") * 7).alias("sv_len"), C("cluster_size").alias("reads")).join(rows, K)


@query(PROBED + " SELECT k1, k2, k3, k4, half_even(reads / (least(left_n, right_n) + 1), 2) AS sv_rate FROM q WHERE reads >= least(left_n, right_n) * 0.4 + 1 OR (sv_type = 'INS' AND sv_len > 2000 AND reads >= least(left_n, right_n) * 0.4 * 0.5)")
def accept_fixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clusters.accept_fixed(probed(spark, sf_dir), 0.4).select(*K, "sv_rate")


@query(cte("sig") + """ SELECT DISTINCT cluster_size, sv_type, concat(CASE WHEN cluster_size > 5 THEN 'high' ELSE 'low' END, CASE WHEN sv_type = 'INS' THEN '_ins' ELSE '' END) AS hifi, concat(CASE WHEN cluster_size > 10 THEN 'high' ELSE 'low' END, CASE WHEN sv_type = 'INS' THEN '_ins' ELSE '' END) AS ont,
concat(CASE WHEN cluster_size > 10 THEN 'high' ELSE 'low' END, CASE WHEN sv_type = 'INS' THEN '_ins' ELSE '' END) AS sr FROM sig""")
def tolerance_choice_fixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = sig(spark, sf_dir).select("cluster_size", "sv_type").distinct()
    return rows.select("*", *[clusters.tolerance_name(C("cluster_size"), C("sv_type"), p, fixed=True).alias(p) for p in ("hifi", "ont", "sr")])


@query(PROBED + " SELECT k1, k2, k3, k4 FROM q WHERE (sv_type = 'DEL' AND depth = 0) OR (break1_n + break2_n) / 2 >= 2 OR (break1_n + break2_n) / 2 + reads >= 4")
def accept_breaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clusters.accept_breaks(probed(spark, sf_dir), 4).select(*K)


@query(PROBED + " SELECT k1, k2, k3, k4, reads >= 0.1 * ((left_n + right_n) / 2) + 0.7 AS long, reads > 0.25 * ((left_n + right_n) / 2) AS other FROM q WHERE reads >= 0.1 * ((left_n + right_n) / 2) + 0.7 OR reads > 0.25 * ((left_n + right_n) / 2)")
def accept_translocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = probed(spark, sf_dir)
    long, other = (clusters.accept_translocations(rows, x).select(*K, F.lit(True).alias(n)) for x, n in ((True, "long"), (False, "other")))
    return long.join(other, K, "full").select(*K, F.coalesce("long", F.lit(False)).alias("long"), F.coalesce("other", F.lit(False)).alias("other"))


@query(PROBED + """, a AS (SELECT *, reads >= (depth + 1) * 0.5 + 1 AS main, (sv_type = 'INS' AND sv_len > 3000 AND reads >= (depth + 1) * 0.5 * 0.6) OR (sv_type = 'DUP' AND sv_len > 500 AND reads >= (depth + 1) * 0.5 * 0.5) OR (sv_type = 'INV' AND reads >= (depth + 1) * 0.5 * 0.5) OR reads >= 4 AS rescue FROM q)
SELECT k1, k2, k3, k4, CASE WHEN main THEN 'main' ELSE 'rescue' END AS accepted, half_even(reads / (depth + 1), 2) AS sv_rate FROM a WHERE reads >= 2 AND (main OR rescue)""")
def accept_reads(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clusters.accept(probed(spark, sf_dir), 0.5, nreads=5).select(*K, "accepted", "sv_rate")


@query(cte("sig") + """ SELECT DISTINCT cluster_size, sv_type, concat(CASE WHEN cluster_size > 5 THEN 'high' ELSE 'low' END, CASE WHEN sv_type = 'INS' THEN '_ins' ELSE '' END) AS hifi, concat(CASE WHEN cluster_size > 10 THEN 'high' ELSE 'low' END, CASE WHEN sv_type = 'INS' THEN '_ins' ELSE '' END) AS pb,
concat('high', CASE WHEN sv_type = 'INS' THEN '_ins' ELSE '' END) AS sr FROM sig""")
def tolerance_choice(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = sig(spark, sf_dir).select("cluster_size", "sv_type").distinct()
    return rows.select("*", *[clusters.tolerance_name(C("cluster_size"), C("sv_type"), p).alias(p) for p in ("hifi", "pb", "sr")])


@query(cte("ratio") + """, x AS (SELECT *, support % 5 AS pairs FROM ratio), g AS (SELECT *, CASE WHEN greatest(a, b) > 0.9 OR (a >= 0.8 AND b >= 0.8) THEN '1/1' WHEN a + b < 0.1 THEN '0/0' ELSE '0/1' END AS lr1,
 CASE WHEN greatest(a, b) >= 0.85 THEN '1/1' WHEN a + b < 0.1 THEN '0/0' ELSE '0/1' END AS clip FROM x)
SELECT k1, k2, k3, k4, CASE WHEN pairs / 4 >= 0.75 THEN '1/1' WHEN pairs = 0 THEN '0/0' ELSE clip END AS inv FROM g""")
def gt_inversion(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ratios(spark, sf_dir).select(*K, genotypes.inversion(C("support") % 5, C("a"), C("b")).alias("inv"))


SHARED = ", s AS (SELECT *, support % 5 AS shared, CASE WHEN depth > 0 THEN half_even((support % 5) / depth, 2) ELSE 0 END AS p, CASE WHEN spans > 0 THEN half_even((support % 5) / spans, 2) ELSE 0 END AS q FROM ratio)"


@query(cte("ratio") + SHARED + """, n AS (SELECT *, CASE WHEN greatest(p, q) > 0.9 OR (p >= 0.8 AND q >= 0.8) THEN '1/1' WHEN p + q < 0.1 THEN '0/0' ELSE '0/1' END AS lr1, CASE WHEN greatest(p, q) > 0.9 OR (p >= 0.8 AND q >= 0.8) THEN '1/1' ELSE '-' END AS sr1 FROM s)
SELECT k1, k2, k3, k4, CASE WHEN lr1 <> '0/1' THEN lr1 WHEN greatest(a, b) >= 0.9 OR (a >= 0.85 AND b >= 0.85) THEN '1/1' WHEN a + b < 0.1 THEN '0/0' ELSE '0/1' END AS lr,
CASE WHEN sr1 = '1/1' OR (a >= 0.6 AND b >= 0.6) OR (greatest(a, b) >= 0.75 AND least(a, b) >= 0.3) THEN '1/1' WHEN greatest(a, b) < 0.05 THEN '0/0' ELSE '0/1' END AS sr FROM n""")
def gt_translocation(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = (C("support") % 5, C("depth"), C("spans"), C("a"), C("b"))
    return ratios(spark, sf_dir).select(*K, genotypes.translocation(*own).alias("lr"), genotypes.short_translocation(*own).alias("sr"))


@query(cte("sig") + " SELECT svid, k1 % 16 AS depth, CASE WHEN k1 % 16 > 0 THEN half_even(cluster_size / (k1 % 16), 3) ELSE 0 END AS ratio, CASE WHEN k1 % 16 = 0 THEN './.' WHEN half_even(cluster_size / (k1 % 16), 3) > 0.65 THEN '1/1' WHEN half_even(cluster_size / (k1 % 16), 3) < 0.1 THEN '0/0' ELSE '0/1' END AS gt FROM sig")
def gt_signal_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = sig(spark, sf_dir).withColumn("depth", C("k1") % 16)
    return genotypes.from_signal_count(rows, C("depth")).select("svid", "depth", "ratio", "gt")


@query(cte("sig") + """ SELECT svid, CASE WHEN sv_type = 'INS' THEN concat('total_map_reads=', k1 % 9) ELSE concat('total_map_reads_l=', k1 % 9, ';total_map_reads_r=', k4 % 9) END AS maps,
CASE WHEN sv_type = 'INS' THEN concat('INS_rate=', k1 % 9, ';INS') ELSE concat('l_ratio=', k1 % 9, ',r_ratio=', k4 % 9, ';', sv_type) END AS rates FROM sig""")
def support_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    maps, rates = genotypes.support_text(C("sv_type"), C("k1") % 9, C("k4") % 9, C("k1") % 9, C("k4") % 9)
    return sig(spark, sf_dir).select("svid", maps.alias("maps"), rates.alias("rates"))


@query(cte("gt") + """ SELECT DISTINCT gt, CAST(gt = '0/0' AS INT) AS ref, CAST(gt = '0/1' AS INT) AS het, CAST(gt = '1/1' AS INT) AS hom, CAST(gt = './.' AS INT) AS missing FROM gt""")
def one_hot_genotypes(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark_table(spark, sf_dir, "gt").select("gt").distinct().withColumn("x", scalars.one_hot_gt(C("gt")))
    return rows.select("gt", *[C("x")[k].alias(n) for k, n in enumerate(("ref", "het", "hom", "missing"))])


@query(cte("ratio") + " SELECT k1, k2, k3, k4, round_even(CAST(size AS DOUBLE) / 16, 1) AS tenth FROM ratio")
def half_even(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ratios(spark, sf_dir).select(*K, scalars.round_half_even(C("size").cast("double") / 16, 1).alias("tenth"))


@query(cte("gt") + ", c AS (SELECT id, chrom, pos, sample, max(gt) AS gt FROM gt GROUP BY ALL) SELECT id, chrom, pos, sample, gt FROM c WHERE gt <> './.'")
def known_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark_table(spark, sf_dir, "gt").groupBy("id", "chrom", "pos", "sample").agg(F.max("gt").alias("gt"))
    return rows.where(cohort.missing_rate([C("gt")], 0) == 0).select("id", "chrom", "pos", "sample", "gt")


LADDER = "CASE WHEN {d} = 0 THEN './.' WHEN {d} <= 5 THEN CASE WHEN floor(0.75 * {d}) + 1 <= {s} THEN '1/1' WHEN {s} / {d} <= 0.2 THEN '0/0' ELSE '0/1' END WHEN {d} <= 10 THEN CASE WHEN 0.75 * {d} + 1 <= {s} THEN '1/1' WHEN 0.05 * {d} + 1 > {s} THEN '0/0' ELSE '0/1' END ELSE CASE WHEN {s} / {d} >= 0.75 THEN '1/1' WHEN {s} / {d} < 0.05 THEN '0/0' ELSE '0/1' END END"



def by_depth_sql(support: str, depth: str) -> str:
    return LADDER.format(s=support, d=depth)


READS = ENDS.replace("WITH RECURSIVE ", cte("var") + ", ", 1).replace("bool_or(i = 1 AND", "any_value(sample) AS sample, any_value(mapq) AS mapq, bool_or(i = 1 AND") + """,
ih AS (SELECT v.*, r.qname, r.sample, r.mapq, r.pos, r.stop AS rstop, r.cut_l, r.cut_r, least(v.size, 300) + least(ceil(v.size * 0.05), 250) AS reach FROM var v JOIN rd r ON v.sv_type = 'INS' AND v.chrom = r.rname AND r.pos <= v.stop + 199 AND r.stop - 1 >= greatest(v.start - 200, 0)),
io AS (SELECT h.vid, h.qname, bool_or(o.n BETWEEN 0.8 * h.size AND 1.2 * h.size) AS fit, sum(CASE WHEN o.n BETWEEN 0.8 * h.size AND 1.2 * h.size THEN 0 ELSE o.n END) AS rest FROM ih h JOIN pl o ON h.qname = o.qname AND o.op = 'I' AND o.n >= 35 AND o.ref > h.start - 300 AND o.ref <= h.stop + h.size GROUP BY ALL),
ie AS (SELECT h.vid, h.sample, any_value(h.size) AS size, count(*) AS reads, count(DISTINCT CASE WHEN o.fit OR (o.rest >= 0.7 * h.size AND o.rest < 1.5 * h.size) THEN h.qname END) AS events,
 CAST(sum(CASE WHEN cut_l AND ((pos >= start - reach AND pos < start + reach) OR (pos >= h.stop - reach AND pos < h.stop + reach)) THEN 1 ELSE 0 END + CASE WHEN cut_r AND ((rstop >= start - reach AND rstop < start + reach) OR (rstop >= h.stop - reach AND rstop < h.stop + reach)) THEN 1 ELSE 0 END) AS BIGINT) AS clips,
 count(CASE WHEN NOT cut_l AND NOT cut_r AND pos + 1000 < start AND rstop - 1000 > h.stop THEN 1 END) AS whole, CAST(ceil(avg(mapq)) AS BIGINT) AS maq FROM ih h LEFT JOIN io o USING (vid, qname) GROUP BY h.vid, h.sample),
i2 AS (SELECT vid, sample, size, reads, events, clips, whole - events AS spans, maq FROM ie)"""


@query(READS + " SELECT vid, sample, reads, events, clips, spans, maq FROM i2")
def gt_insertion_evidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return genotypes.insertion_evidence(spark_table(spark, sf_dir, "var"), align(spark, sf_dir))


DELS = READS + """, side(edge) AS (VALUES ('l'), ('r')),
dh AS (SELECT v.*, s.edge, CASE s.edge WHEN 'l' THEN v.start ELSE v.stop END AS place, r.qname, r.sample, r.mapq, r.pos, r.stop AS rstop, r.cut_l, r.cut_r, 200 + least(ceil(v.size * 0.05), 500) AS reach
 FROM var v CROSS JOIN side s JOIN rd r ON v.sv_type = 'DEL' AND v.chrom = r.rname AND r.pos <= CASE s.edge WHEN 'l' THEN v.start ELSE v.stop END + 199 AND r.stop - 1 >= greatest(CASE s.edge WHEN 'l' THEN v.start ELSE v.stop END - 200, 0)),
dr AS (SELECT h.vid, h.edge, h.qname, h.size, o.n, sum(CASE WHEN o.n >= 35 THEN o.n ELSE 0 END) OVER (PARTITION BY h.vid, h.edge, h.qname ORDER BY o.i ROWS UNBOUNDED PRECEDING) AS total FROM dh h JOIN pl o ON h.qname = o.qname AND o.op = 'D' AND o.ref > h.start - 200 AND o.ref < h.stop + 200),
d1 AS (SELECT vid, edge, qname, bool_or(n BETWEEN 0.8 * size AND 1.2 * size OR (n >= 35 AND total BETWEEN 0.8 * size AND 1.2 * size)) OR max(total) BETWEEN 0.7 * any_value(size) AND 1.5 * any_value(size) AS hit FROM dr GROUP BY vid, edge, qname),
d2 AS (SELECT h.vid, h.edge, h.sample, any_value(h.size) AS size, count(*) AS reads, count(DISTINCT CASE WHEN o.hit THEN h.qname END) AS events,
 CAST(sum(CASE WHEN cut_l AND pos > h.stop - 0.5 * h.size AND pos >= place - reach AND pos < place + reach THEN 1 ELSE 0 END + CASE WHEN cut_r AND rstop < h.start + 0.5 * h.size AND rstop >= place - reach AND rstop < place + reach THEN 1 ELSE 0 END) AS BIGINT) AS clips, CAST(ceil(avg(mapq)) AS BIGINT) AS maq FROM dh h LEFT JOIN d1 o USING (vid, edge, qname) GROUP BY h.vid, h.edge, h.sample)"""


@query(DELS + " SELECT vid, edge, sample, reads, events, clips, maq FROM d2")
def gt_deletion_evidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return genotypes.deletion_evidence(spark_table(spark, sf_dir, "var"), align(spark, sf_dir)).withColumnRenamed("side", "edge")


@query(DELS + f""", sm(sample) AS (VALUES ('s0'), ('s1'), ('s2'), ('s9')), asked AS (SELECT vid, size, sv_type, sample FROM var, sm),
gi AS (SELECT a.vid, a.sample, a.size, coalesce(reads, 0) AS r, coalesce(events, 0) AS ev, coalesce(clips, 0) AS cl, coalesce(spans, 0) AS sp, coalesce(maq, 0) AS maq FROM asked a LEFT JOIN i2 ON a.vid = i2.vid AND a.sample = i2.sample WHERE sv_type = 'INS'),
g1 AS (SELECT *, {LADDER.format(s="(ev + cl)", d="r")} AS g FROM gi), g2 AS (SELECT *, CASE WHEN g = '1/1' AND floor(0.08 * r) + 1 <= sp THEN '0/1' ELSE g END AS h FROM g1),
gd AS (SELECT a.vid, a.sample, a.size, coalesce(x.reads, 0) AS rl, coalesce(y.reads, 0) AS rr, coalesce(x.events, 0) AS el, coalesce(y.events, 0) AS er, coalesce(x.clips, 0) AS cl, coalesce(y.clips, 0) AS cr, coalesce(x.maq, 0) AS ml, coalesce(y.maq, 0) AS mr
 FROM asked a LEFT JOIN d2 x ON x.edge = 'l' AND a.vid = x.vid AND a.sample = x.sample LEFT JOIN d2 y ON y.edge = 'r' AND a.vid = y.vid AND a.sample = y.sample WHERE sv_type = 'DEL'),
e1 AS (SELECT *, {LADDER.format(s="greatest(el + cl, er + cr)", d="(CASE WHEN el + cl > er + cr THEN rl ELSE rr END)")} AS g FROM gd)
SELECT vid, sample, CASE WHEN r = 0 THEN './.' WHEN h <> '0/0' AND size < 800 AND ev = 0 THEN '0/0' ELSE h END AS gt, r AS reads_l, CAST(0 AS BIGINT) AS reads_r, CASE WHEN r > 0 THEN half_even((ev + cl) / r, 3) ELSE 0 END AS ratio_l, CAST(0 AS DOUBLE) AS ratio_r, maq FROM g2
UNION ALL SELECT vid, sample, CASE WHEN rl + rr = 0 THEN './.' WHEN g <> '0/0' AND size < 1000 AND el + er = 0 THEN '0/0' ELSE g END, rl, rr, CASE WHEN rl > 0 THEN half_even((el + cl) / rl, 3) ELSE 0 END, CASE WHEN rr > 0 THEN half_even((er + cr) / rr, 3) ELSE 0 END, greatest(ml, mr) FROM e1""")
def gt_from_reads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Genotypes of insertions and deletions from alignments, end to end."""
    return genotypes.long_read_calls(spark_table(spark, sf_dir, "var"), align(spark, sf_dir), ["s0", "s1", "s2", "s9"])
