"""Gene models and the effect of variants on them, by interval joins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from strandmill.functions.scalars import promoter
from strandmill.operators.intervals import overlap_join


def gene_parts(genes: DataFrame, cds: DataFrame, single_cds_utr: bool = True) -> DataFrame:
    """genes: gene, chrom, start, stop, strand; cds: gene, start, stop. One row per part: gene, chrom, part (cds1..,
    intron1.., utr5, utr3), start, stop. Parts count in reading direction. single_cds_utr=False leaves out the
    untranslated ends of genes of one coding part."""
    by = Window.partitionBy("gene").orderBy("start", "stop")
    coded = cds.select("gene", "start", "stop").join(genes.select("gene", "chrom", "strand", F.col("start").alias("g0"), F.col("stop").alias("g1")), "gene")
    rank = F.row_number().over(by)
    coded = coded.withColumns({"n": F.count(F.lit(1)).over(Window.partitionBy("gene")), "k": rank, "next": F.lead("start").over(by)})
    number = lambda k, n: F.when(F.col("strand") == "-", n - k + 1).otherwise(k)
    exon = coded.select("gene", "chrom", F.concat(F.lit("cds"), number(F.col("k"), F.col("n"))).alias("part"), "start", "stop")
    intron = coded.where(F.col("next").isNotNull() & (F.col("stop") + 1 <= F.col("next") - 1)).select(
        "gene", "chrom", F.concat(F.lit("intron"), number(F.col("k"), F.col("n") - 1)).alias("part"), (F.col("stop") + 1).alias("start"), (F.col("next") - 1).alias("stop"))
    ends = coded.groupBy("gene", "chrom", "strand", "g0", "g1", "n").agg(F.min("start").alias("c0"), F.max("stop").alias("c1"))
    ends = ends if single_cds_utr else ends.where("n > 1")
    plus = F.col("strand") == "+"
    sides = F.array(
        F.when(F.col("g0") < F.col("c0"), F.struct(F.when(plus, "utr5").otherwise("utr3").alias("part"), F.col("g0").alias("start"), F.col("c0").alias("stop"))),
        F.when(F.col("c1") < F.col("g1"), F.struct(F.when(plus, "utr3").otherwise("utr5").alias("part"), F.col("c1").alias("start"), F.col("g1").alias("stop"))),
    )
    utr = ends.select("gene", "chrom", F.explode(F.filter(sides, lambda s: s.isNotNull())).alias("s")).select("gene", "chrom", "s.part", "s.start", "s.stop")
    return exon.unionByName(intron).unionByName(utr)


def _half_open(variants: DataFrame, parts: DataFrame) -> DataFrame:
    """Pairs of [start, stop) variants and parts."""
    v = variants.withColumn("__last", F.col("stop") - 1)
    p = parts.where("start < stop").withColumn("last", F.col("stop") - 1)
    return overlap_join(v, p, None, ("chrom", "start", "__last"), ("chrom", "start", "last")).drop("__last", "r_last", "r_chrom")


def _is(kind: str) -> Column:
    return F.col("r_part").startswith(kind)


def deletion_impact(variants: DataFrame, parts: DataFrame, least: int = 40) -> DataFrame:
    """Deletions wider than least with each part they touch: what is lost, how many bases, and the impact."""
    s, e, a, b = F.col("start"), F.col("stop"), F.col("r_start"), F.col("r_stop")
    hits = _half_open(variants.where((F.col("sv_type") == "DEL") & (e - s > least)), parts)
    case = (
        F.when((s <= a) & (e >= b), F.struct(F.lit("all").alias("lost"), (b - a + 1).alias("bases")))
        .when((s < a) & (e <= b) & (e > a), F.struct(F.lit("left").alias("lost"), (e - a + 1).alias("bases")))
        .when((s > a) & (s < b) & (e > b), F.struct(F.lit("right").alias("lost"), (b - s + 1).alias("bases")))
        .when((s >= a) & (e <= b), F.struct(F.lit("center").alias("lost"), (e - s + 1).alias("bases")))
    )
    hits = hits.withColumn("c", case).where("c is not null").withColumns({"lost": F.col("c.lost"), "bases": F.col("c.bases")}).drop("c")
    whole = F.col("lost") == "all"
    impact = (
        F.when(_is("cds"), F.when(whole | (F.pmod("bases", F.lit(3)) == 0), "AS").otherwise("frameshift"))
        .when(_is("utr"), "Exp").otherwise(F.when(whole, "intron_lost").otherwise("intron_smaller"))
    )
    return hits.withColumn("impact", impact)


def insertion_impact(variants: DataFrame, parts: DataFrame) -> DataFrame:
    """Insertions (one base wide) with each part they fall in."""
    hits = _half_open(variants.where((F.col("sv_type") == "INS") & (F.col("stop") - F.col("start") == 1)), parts)
    impact = F.when(_is("cds"), F.when(F.pmod(F.abs("sv_len"), F.lit(3)) == 0, "AS").otherwise("frameshift")).when(_is("utr"), "Exp").otherwise("intron_exten")
    return hits.withColumn("impact", impact)


def impact_text(impacts: DataFrame, ident: list[str]) -> DataFrame:
    """One text per variant: distinct gene__part:impact, in order."""
    return impacts.groupBy(*ident).agg(F.array_join(F.array_sort(F.collect_set(F.concat("r_gene", F.lit("__"), "r_part", F.lit(":"), "impact"))), ", ").alias("struc"))


def promoters(genes: DataFrame, size: int = 3000) -> DataFrame:
    low, high = promoter(F.col("start"), F.col("stop"), F.col("strand"), size)
    return genes.select("gene", "chrom", F.lit("3k_promoter").alias("part"), low.alias("start"), high.alias("stop")).where("start <= stop")


def position_annotation(variants: DataFrame, genes: DataFrame, cds: DataFrame, ident: list[str]) -> DataFrame:
    """Per variant the genes, coding parts and promoters it touches, in order; GenePAV marks a gene wholly covered."""
    places = genes.select("gene", "chrom", F.lit("gene").alias("part"), "start", "stop").unionByName(cds.join(genes.select("gene", "chrom"), "gene").select("gene", "chrom", F.lit("CDS").alias("part"), "start", "stop")).unionByName(promoters(genes))
    hits = _half_open(variants, places)
    covers = (F.col("r_part") == "gene") & (F.col("start") <= F.col("r_start")) & (F.col("stop") >= F.col("r_stop"))
    label = F.concat("r_gene", F.lit(":"), F.when(covers, "GenePAV").otherwise(F.col("r_part")))
    listed = lambda part: F.array_join(F.array_sort(F.collect_set(F.when(F.col("r_part") == part, label))), ",")
    return hits.groupBy(*ident).agg(listed("gene").alias("genes"), listed("CDS").alias("cds"), listed("3k_promoter").alias("promoters"))
