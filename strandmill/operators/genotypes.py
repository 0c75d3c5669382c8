"""Genotype rules as column expressions, and the evidence tables they read.

All rules take counts and ratios as columns; evidence comes from one interval join of variants with
reads, aggregated by variant and sample, in place of one fetch per variant.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandmill.functions.scalars import interior_points, round_half_even, signed_sizes
from strandmill.operators.alignments import is_reverse, mapped_length, operations, sa_segments
from strandmill.operators.intervals import count_overlaps, left_levels, overlap_join

REF, HET, HOM, MISSING = "0/0", "0/1", "1/1", "./."


def by_depth(support: Column, depth: Column, homo: float = 0.75, ref: float = 0.05) -> Column:
    """Long reads: strict in small depths (to 5, to 10), by the ratio above."""
    ratio = F.try_divide(support, depth)
    small = F.when(F.floor(homo * depth) + 1 <= support, HOM).when(ratio <= 0.2, REF).otherwise(HET)
    middle = F.when(homo * depth + 1 <= support, HOM).when(0.05 * depth + 1 > support, REF).otherwise(HET)
    large = F.when(ratio >= homo, HOM).when(ratio < ref, REF).otherwise(HET)
    return F.when(depth == 0, MISSING).when(depth <= 5, small).when(depth <= 10, middle).otherwise(large)


def by_ratio(ratio: Column, homo: float = 0.65, ref: float = 0.10, strict: bool = False) -> Column:
    """At least homo (more than it, if strict), under ref, between."""
    return F.when(ratio > homo if strict else ratio >= homo, HOM).when(ratio < ref, REF).otherwise(HET)


#: Rules on the ratios of two breakpoints by platform and type: (a, b, larger, smaller) to homozygous and reference conditions.
TWO_BREAKPOINTS = {
    "lr_dup": (lambda a, b, hi, lo: ((a >= 0.4) & (b >= 0.4)) | (a + b >= 0.9), lambda a, b, hi, lo: a + b < 0.1),
    "lr_inv": (lambda a, b, hi, lo: hi >= 0.85, lambda a, b, hi, lo: a + b < 0.1),
    "lr_tra_names": (lambda a, b, hi, lo: (hi > 0.9) | (lo >= 0.8), lambda a, b, hi, lo: a + b < 0.1),
    "lr_tra": (lambda a, b, hi, lo: (hi >= 0.9) | (lo >= 0.85), lambda a, b, hi, lo: a + b < 0.1),
    "sr_dup": (lambda a, b, hi, lo: (lo >= 0.25) | ((hi >= 0.3) & (lo >= 0.1)), lambda a, b, hi, lo: hi < 0.05),
    "sr_inv": (lambda a, b, hi, lo: (lo >= 0.6) | ((hi >= 0.75) & (lo >= 0.3)), lambda a, b, hi, lo: hi < 0.05),
    "sr_tra": (lambda a, b, hi, lo: (lo >= 0.6) | ((hi >= 0.75) & (lo >= 0.3)), lambda a, b, hi, lo: hi < 0.05),
    "sr_breaks": (lambda a, b, hi, lo: (hi > 0.75) & (lo > 0.4), lambda a, b, hi, lo: (hi < 0.2) | (lo < 0.1)),
    "cr_dup": (lambda a, b, hi, lo: hi > 0.6, lambda a, b, hi, lo: hi < 0.2),
    "cr_inv": (lambda a, b, hi, lo: (hi > 0.7) & (lo >= 0.55), lambda a, b, hi, lo: (hi < 0.3) | (lo < 0.15)),
    "force_inv": (lambda a, b, hi, lo: hi >= 0.8, lambda a, b, hi, lo: a + b < 0.1),
}

#: Rules on one ratio: homozygous, whether more than it is needed, reference bound.
ONE_RATIO = {
    "lr_dup_small": (0.75, True, 0.05), "lr_dup_sa": (0.625, False, 0.1), "cr": (0.65, True, 0.15), "cr_sa": (0.6, False, 0.2),
    "force_sa": (0.6, False, 0.05), "signal": (0.65, True, 0.1), "sr": (0.65, False, 0.1),
}


def by_two(a: Column, b: Column, rule: str) -> Column:
    hom, ref = (f(a, b, F.greatest(a, b), F.least(a, b)) for f in TWO_BREAKPOINTS[rule])
    return F.when(hom, HOM).when(ref, REF).otherwise(HET)


def by_one(ratio: Column, rule: str) -> Column:
    homo, strict, ref = ONE_RATIO[rule]
    return by_ratio(ratio, homo, ref, strict)


def share(n: Column, depth: Column, digits: int = 3) -> Column:
    return F.when(depth > 0, round_half_even(n / depth, digits)).otherwise(0.0)


def insertion(events: Column, clips: Column, reads: Column, spans: Column, size: Column, homo: float = 0.75, ref: float = 0.05) -> Column:
    """Long reads: events are reads with a fitting insertion, clips clip ends near it, spans reads across it."""
    first = by_depth(events + clips, reads, homo, ref)
    second = F.when((first == HOM) & (F.floor(0.08 * reads) + 1 <= spans), HET).otherwise(first)
    return F.when((reads > 0) & (second != REF) & (size < 800) & (events == 0), REF).otherwise(second)


def deletion(events_l: Column, clips_l: Column, reads_l: Column, events_r: Column, clips_r: Column, reads_r: Column, size: Column, homo: float = 0.75, ref: float = 0.05) -> Column:
    """Long reads: the side of more support decides, of equal ones the right."""
    a, b = events_l + clips_l, events_r + clips_r
    gt = by_depth(F.greatest(a, b), F.when(a > b, reads_l).otherwise(reads_r), homo, ref)
    gt = F.when((gt != REF) & (size < 1000) & (events_l + events_r == 0), REF).otherwise(gt)
    return F.when(reads_l + reads_r == 0, MISSING).otherwise(gt)


def inversion(rate: Column, clip_a: Column, clip_b: Column) -> Column:
    """Long reads: by the rate of supplementary segments that link both breakpoints; undecided ones by clips."""
    return F.when(rate / 4 >= 0.75, HOM).when(rate == 0, REF).otherwise(by_two(clip_a, clip_b, "lr_inv"))


def translocation(shared: Column, reads_a: Column, reads_b: Column, clip_a: Column, clip_b: Column) -> Column:
    """Long reads: by names seen on both sides over each side's reads; undecided ones by clips."""
    first = by_two(share(shared, reads_a, 2), share(shared, reads_b, 2), "lr_tra_names")
    return F.when(first == HET, by_two(clip_a, clip_b, "lr_tra")).otherwise(first)


def short_insertion(ratio: Column, reads: Column, spans: Column, homo: float = 0.65, ref: float = 0.1) -> Column:
    gt = by_ratio(ratio, homo, ref)
    out = F.when((gt == HET) & (spans <= 0.01 * reads + 1), HOM).when((gt == HOM) & (spans >= 0.05 * reads + 1), HET).otherwise(gt)
    return F.when(reads == 0, MISSING).otherwise(out)


def short_deletion(ratio: Column, reads: Column, spans: Column, empty_points: Column, homo: float = 0.65, ref: float = 0.1) -> Column:
    """No reads, no spanning reads, or two uncovered interior points at least make it homozygous."""
    gt = by_ratio(ratio, homo, ref)
    out = F.when(spans == 0, HOM).when((gt == HOM) & (spans >= 0.3 * reads + 2), HET).otherwise(gt)
    return F.when((reads == 0) | (empty_points >= 2), HOM).otherwise(out)


def short_translocation(shared: Column, reads_a: Column, reads_b: Column, clip_a: Column, clip_b: Column) -> Column:
    first = by_two(share(shared, reads_a, 2), share(shared, reads_b, 2), "lr_tra_names")
    return F.when(first == HOM, first).otherwise(by_two(clip_a, clip_b, "sr_tra"))


def from_signal_rate(candidates: DataFrame, sample: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """Genotypes from the candidates' own rates, no reads: depth is the cluster's size over its rate, rounded up. keep: further columns."""
    target, query = signed_sizes(F.col("sv_type"), F.col("sv_len"))
    rate = F.col("sv_rate")
    return candidates.select(
        "chrom", "start", "stop", target.alias("target_size"), query.alias("query_size"), "sv_type", F.lit(sample).alias("sample"),
        by_one(rate, "signal").alias("gt"), F.ceil(F.try_divide(F.col("cluster_size"), rate)).alias("reads"), round_half_even(rate, 2).alias("ratio"), *keep,
    )


def from_signal_count(candidates: DataFrame, depth: Column) -> DataFrame:
    """Genotypes from cluster sizes over local depth, a column."""
    return candidates.withColumn("ratio", share(F.col("cluster_size"), depth)).withColumn("gt", F.when(depth == 0, MISSING).otherwise(by_one(F.col("ratio"), "signal")))


def support_text(sv_type: Column, reads_a: Column, reads_b: Column, ratio_a: Column, ratio_b: Column) -> tuple[Column, Column]:
    """The two text fields of a genotype line."""
    one = F.concat(F.lit("total_map_reads="), reads_a.cast("string"))
    two = F.concat(F.lit("total_map_reads_l="), reads_a.cast("string"), F.lit(";total_map_reads_r="), reads_b.cast("string"))
    rates = F.concat(F.lit("l_ratio="), ratio_a.cast("string"), F.lit(",r_ratio="), ratio_b.cast("string"), F.lit(";"), sv_type)
    return F.when(sv_type == "INS", one).otherwise(two), F.when(sv_type == "INS", F.concat(F.lit("INS_rate="), ratio_a.cast("string"), F.lit(";INS"))).otherwise(rates)


def aligned(reads: DataFrame, least: int, **more: Column) -> DataFrame:
    """Mapped reads as intervals (closed), with their deletions, insertions of least bases at least, and clipped ends; more: further columns.
    A read is taken apart in one pass, and once: as rows of an exploded array, what it gives is not worked out again by the filters on it."""
    none = F.array().cast("array<struct<n:bigint,ref:bigint>>")

    def step(a: Column, o: Column) -> Column:
        # the operations' sizes and places alone: reads are moved in several rows, and no join reads more of them
        at = F.struct(o["n"].alias("n"), a["ref"].alias("ref"))
        add = lambda name, kind, n: F.when((o["op"] == kind) & (o["n"] >= n), F.array_append(a[name], at)).otherwise(a[name]).alias(name)
        on = F.when(o["op"].isin("M", "D", "N", "=", "X"), o["n"]).otherwise(0)
        return F.struct((a["ref"] + on).alias("ref"), add("dels", "D", 1), add("inss", "I", least))

    begin = F.struct(F.col("pos").cast("long").alias("ref"), none.alias("dels"), none.alias("inss"))
    apart = F.aggregate(operations(F.col("cigar")), begin, step)
    found = F.struct(apart.alias("o"), F.col("cigar").rlike("^[0-9]+[SH]").alias("l"), F.col("cigar").rlike("[SH]$").alias("r"), *[c.alias(n) for n, c in more.items()])
    lines = reads.where(F.col("flag").bitwiseAND(4) == 0).select("sample", "qname", "mapq", F.col("rname").alias("chrom"), F.col("pos").alias("start"), F.explode(F.array(found)).alias("f"))
    return lines.select(
        "sample", "qname", "mapq", "chrom", "start", (F.col("f.o.ref") - 1).alias("last"), F.when(F.col("f.l"), F.col("start")).alias("clip_l"), F.when(F.col("f.r"), F.col("f.o.ref")).alias("clip_r"),
        *[F.col(f"f.{n}").alias(n) for n in more], F.col("f.o.dels").alias("dels"), F.col("f.o.inss").alias("inss"),
    )


def _within(place: Column, at: Column, reach: Column) -> Column:
    return F.coalesce((place >= at - reach) & (place < at + reach), F.lit(False))


def _met(places: DataFrame, lines: DataFrame, low: str, high: str) -> DataFrame:
    """places with the lines (of aligned()) that overlap low to high. Clipped ends move as marks: they lie where the read begins or ends."""
    marked = lines.withColumns({"clip_l": F.col("clip_l").isNotNull(), "clip_r": F.col("clip_r").isNotNull()})
    hits = overlap_join(places, marked, None, ("chrom", low, high), ("chrom", "start", "last"), sizes=left_levels(places, low, high))
    return hits.withColumns({"r_clip_l": F.when(F.col("r_clip_l"), F.col("r_start")), "r_clip_r": F.when(F.col("r_clip_r"), F.col("r_last") + 1)})


def long_evidence(variants: DataFrame, reads: DataFrame, shift: int = 200, least: int = 35, kinds: tuple[str, ...] = ("INS", "DEL")) -> DataFrame:
    """Per insertion (side i) and end of a deletion (side l or r) of the variants (vid, chrom, start, stop, size, sv_type), and sample:
    reads within shift; events; clips; spans; maq, the mean quality rounded up.

    Insertions: events are names of reads with an insertion of 0.8 to 1.2 times the size (from 300 before it to its size after it), or
    whose others there add up to 0.7 to 1.5 times it; clips, clipped ends near the start or stop (within the size, 300 at most,
    and a twentieth of it, 250 at most); spans, reads without clips that pass it by 1000 bases on both sides, less the events.
    Deletions, around an end: events are names of reads with a deletion of 0.8 to 1.2 times the size (within 200 of it), or whose
    running total of those of least bases comes to it, or ends at 0.7 to 1.5 times it; clips, left ends that begin past the
    middle and right ends that stop before it, within the shift and a twentieth of the size, 500 at most.
    Reads are taken apart once, one interval join serves all variants and ends, and rows are counted in the tasks that meet them; of
    types that kinds leaves out neither variants nor operations move."""
    size, start, stop, side = F.col("size"), F.col("start"), F.col("stop"), F.col("side")
    ends = F.when(F.col("sv_type") == "INS", F.array(F.lit("i"))).when(F.col("sv_type") == "DEL", F.array(F.lit("l"), F.lit("r")))
    own = variants.where(F.col("sv_type").isin(*kinds)).select("vid", "chrom", "start", "stop", "size", "sv_type", F.explode(ends).alias("side"))
    place = F.when(side == "r", stop).otherwise(start)
    far = F.when(side == "i", stop).otherwise(place)
    near = own.withColumns({"here": place, "__low": F.greatest(place - shift, F.lit(0)), "__high": far + shift - 1})
    lines = aligned(reads, least)
    lines = lines.withColumns({n: F.lit(None).cast(lines.schema[n].dataType) for n, kind in (("inss", "INS"), ("dels", "DEL")) if kind not in kinds})
    hits = _met(near, lines, "__low", "__high")

    inserted = F.filter("r_inss", lambda o: (o["ref"] > start - 300) & (o["ref"] <= stop + size))
    fit = lambda n: (n >= 0.8 * size) & (n <= 1.2 * size)
    rest = F.aggregate(F.filter(inserted, lambda o: ~fit(o["n"])), F.lit(0).cast("long"), lambda a, o: a + o["n"])
    grown = F.exists(inserted, lambda o: fit(o["n"])) | ((rest >= 0.7 * size) & (rest < 1.5 * size))
    deleted = F.filter("r_dels", lambda o: (o["ref"] > start - 200) & (o["ref"] < stop + 200))

    def step(a: Column, o: Column) -> Column:
        total = a["total"] + F.when(o["n"] >= least, o["n"]).otherwise(0)
        return F.struct(total.alias("total"), (a["hit"] | fit(o["n"]) | ((o["n"] >= least) & fit(total))).alias("hit"))

    fold = F.aggregate(deleted, F.struct(F.lit(0).cast("long").alias("total"), F.lit(False).alias("hit")), step)
    hits = hits.withColumn("__fold", F.when(side != "i", fold))
    lost = F.col("__fold.hit") | ((F.col("__fold.total") >= 0.7 * size) & (F.col("__fold.total") <= 1.5 * size))
    event = F.when(side == "i", grown).otherwise(lost)

    around = F.least(size, F.lit(300)) + F.least(F.ceil(size * 0.05), F.lit(250))
    either = lambda c: _within(F.col(c), start, around) | _within(F.col(c), stop, around)
    reach = F.lit(shift) + F.least(F.ceil(size * 0.05), F.lit(500))
    left = _within(F.col("r_clip_l"), F.col("here"), reach) & (F.col("r_clip_l") > stop - 0.5 * size)
    right = _within(F.col("r_clip_r"), F.col("here"), reach) & (F.col("r_clip_r") < start + 0.5 * size)
    cut = [F.when(side == "i", either(c)).otherwise(own_end).cast("int") for c, own_end in (("r_clip_l", left), ("r_clip_r", right))]
    whole = (side == "i") & F.col("r_clip_l").isNull() & F.col("r_clip_r").isNull() & (F.col("r_start") + 1000 < start) & (F.col("r_last") + 1 - 1000 > stop)
    events = F.count_distinct(F.when(event, F.col("r_qname")))
    return hits.groupBy("vid", "side", F.col("r_sample").alias("sample")).agg(
        F.count(F.lit(1)).alias("reads"), events.alias("events"), F.sum(cut[0] + cut[1]).alias("clips"), (F.count(F.when(whole, 1)) - events).alias("spans"), F.ceil(F.avg("r_mapq")).alias("maq"),
    )


def insertion_evidence(variants: DataFrame, reads: DataFrame, shift: int = 200, least: int = 35) -> DataFrame:
    """long_evidence() of insertions."""
    return long_evidence(variants, reads, shift, least, ("INS",)).drop("side")


def deletion_evidence(variants: DataFrame, reads: DataFrame, shift: int = 200, least: int = 35) -> DataFrame:
    """long_evidence() of both ends of deletions, without spans."""
    return long_evidence(variants, reads, shift, least, ("DEL",)).drop("spans")


def long_read_calls(variants: DataFrame, reads: DataFrame, samples: list[str], shift: int = 200, least: int = 35, homo: float = 0.75, ref: float = 0.05, ins_homo: float = 0.75) -> DataFrame:
    """Genotypes of insertions and deletions (variants: vid, chrom, start, stop, size, sv_type) from reads, for every one of the
    samples; variants without reads there are missing. homo (of insertions ins_homo) and ref: the shares of reads from which a call is
    homozygous and under which it is the reference."""
    asked = variants.select("vid", "size", "sv_type", F.explode(F.array(*map(F.lit, samples))).alias("sample"))
    # one row of each variant and sample, all ends side by side, so the evidence is joined to the variants once
    evidence = long_evidence(variants, reads, shift, least)
    wide = evidence.groupBy("vid", "sample").agg(*[F.max(F.when(F.col("side") == k, F.col(n))).alias(f"{n}_{k}") for k in "ilr" for n in ("reads", "events", "clips", "spans", "maq")])
    found = asked.where(F.col("sv_type").isin("INS", "DEL")).join(wide, ["vid", "sample"], "left")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0).cast("long"))
    insert = F.col("sv_type") == "INS"
    one = F.when(zero("reads_i") == 0, MISSING).otherwise(insertion(zero("events_i"), zero("clips_i"), zero("reads_i"), zero("spans_i"), F.col("size"), ins_homo, ref))
    two = deletion(*[zero(f"{n}_{k}") for k in "lr" for n in ("events", "clips", "reads")], F.col("size"), homo, ref)
    ratio = {k: share(zero(f"events_{k}") + zero(f"clips_{k}"), zero(f"reads_{k}")) for k in "ilr"}
    return found.select(
        "vid", "sample", F.when(insert, one).otherwise(two).alias("gt"), F.when(insert, zero("reads_i")).otherwise(zero("reads_l")).alias("reads_l"), zero("reads_r").alias("reads_r"),
        F.when(insert, ratio["i"]).otherwise(ratio["l"]).alias("ratio_l"), ratio["r"].alias("ratio_r"), F.when(insert, zero("maq_i")).otherwise(F.greatest(zero("maq_l"), zero("maq_r"))).alias("maq"),
    )


def shared_names(left: DataFrame, right: DataFrame, ident: list[str]) -> DataFrame:
    """Per key: distinct names on both sides, and both sides' row counts. left, right: the key and qname."""
    a = left.groupBy(*ident, "qname").agg(F.count(F.lit(1)).alias("a"))
    b = right.groupBy(*ident, "qname").agg(F.count(F.lit(1)).alias("b"))
    both = a.join(b, [*ident, "qname"], "full")
    return both.groupBy(*ident).agg(F.count(F.when(F.col("a").isNotNull() & F.col("b").isNotNull(), 1)).alias("shared"), F.coalesce(F.sum("a"), F.lit(0)).alias("reads_a"), F.coalesce(F.sum("b"), F.lit(0)).alias("reads_b"))


def breakpoints(variants: DataFrame, reach: Column) -> DataFrame:
    """Two rows of each variant (vid, sv_type, chrom, start, chrom2, stop, size): side (l or r), chrom, here, there (the other
    breakpoint's place), and low to high, the places within reach (an expression over sv_type and size) of here."""
    end = lambda side, chrom, here, there: F.struct(F.lit(side).alias("side"), F.col(chrom).alias("chrom"), F.col(here).alias("here"), F.col(there).alias("there"))
    ends = variants.select("vid", "sv_type", "size", F.explode(F.array(end("l", "chrom", "start", "stop"), end("r", "chrom2", "stop", "start"))).alias("e"))
    return ends.select("vid", "sv_type", "size", "e.*").withColumns({"low": F.greatest(F.col("here") - reach, F.lit(0)), "high": F.col("here") + reach - 1})


def _clipped(at: Column, reach: Column) -> Column:
    return _within(F.col("r_clip_l"), at, reach).cast("int") + _within(F.col("r_clip_r"), at, reach).cast("int")


def breakpoint_evidence(points: DataFrame, reads: DataFrame, clip_reach: Column, link_reach: int = 2000, least_maq: int = 0, linked: tuple[str, ...] = ("DUP", "INV", "TRA"), wide: bool = False) -> DataFrame:
    """Per breakpoint (rows of breakpoints()) and sample: reads; near, those within clip_reach; clips, clipped ends there; grown,
    insertions there of 0.6 to 1.5 times the size; maq, the mean quality rounded up; links, supplementary segments that lead from a
    left breakpoint, near which the read ends, to the right one, or from a right one, near which it starts, to the left one, within
    link_reach: inversions by segments of the other strand, duplications of the same one, translocations of another chromosome.
    Unmapped reads and those under least_maq take no part; reads without SA tags have no links. linked: the types whose links are counted.
    wide: place_evidence() instead, of places of every kind."""
    if wide:
        return place_evidence(points, reads, linked)
    hits = _breakpoint_hits(points, reads.where(F.col("mapq") >= least_maq))
    counts = _breakpoint_counts(clip_reach, link_reach, linked)
    return hits.groupBy("vid", "side", F.col("r_sample").alias("sample")).agg(*[F.sum(n).alias(name) for name, n in counts.items()], F.ceil(F.avg("r_mapq")).alias("maq"))


def _breakpoint_hits(points: DataFrame, reads: DataFrame) -> DataFrame:
    """Points with the reads within low to high, and the places of these reads' further segments."""
    segment = lambda s: F.struct(s["chrom"].alias("chrom"), s["pos"].alias("start"), (s["pos"] + mapped_length(s["cigar"])).alias("stop"), (s["strand"] == "-").alias("reverse"))
    lines = aligned(reads, 1, reverse=is_reverse(F.col("flag")), segments=F.transform(sa_segments(F.col("sa")), segment))
    return _met(points, lines, "low", "high")


def _breakpoint_counts(clip_reach: Column, link_reach: int, linked: tuple[str, ...]) -> dict[str, Column]:
    """What a row of _breakpoint_hits() adds to the counts of its breakpoint."""
    left, here, there, kind = F.col("side") == "l", F.col("here"), F.col("there"), F.col("sv_type")
    close = lambda p: F.abs(p - there) <= link_reach

    def leads(s: Column) -> Column:
        inside = (s["chrom"] == F.col("chrom")) & close(F.when(left, s["start"]).otherwise(s["stop"])) & ((s["reverse"] != F.col("r_reverse")) == (kind == "INV"))
        return F.when(kind == "TRA", (s["chrom"] != F.col("chrom")) & (close(s["start"]) | close(s["stop"]))).otherwise(inside)

    own = F.abs(F.when(left, F.col("r_last") + 1).otherwise(F.col("r_start")) - here) <= link_reach
    links = F.when(kind.isin(*linked) & own & F.col("r_segments").isNotNull(), F.size(F.filter("r_segments", leads))).otherwise(0) if linked else F.lit(0)
    near = (F.col("r_start") < here + clip_reach) & (F.col("r_last") >= F.greatest(here - clip_reach, F.lit(0)))
    grown = F.size(F.filter("r_inss", lambda o: (o["n"] > 0.6 * F.col("size")) & (o["n"] < 1.5 * F.col("size")) & _within(o["ref"] - 1, here, clip_reach) & _within(o["ref"], here, clip_reach)))
    return {"reads": F.lit(1), "near": near.cast("int"), "clips": _clipped(here, clip_reach), "grown": grown, "links": links}


def place_evidence(places: DataFrame, reads: DataFrame, linked: tuple[str, ...] = ()) -> DataFrame:
    """Per variant and sample, in one row, the counts of all rules on long reads: of each side k reads_k, near_k, clips_k, links_k,
    events_k, fitting_k, whole_k and maq_k; and shared, names of a translocation's reads on both sides. places: rows of breakpoints() with
    reach, how near clips and operations lie; short duplications, insertions (side i: the whole region, here to there) and deletions (l, r) too.
    One interval join serves all of them, and reads are taken apart once."""
    hits, c, size = _breakpoint_hits(places, reads), F.col, F.col("size")
    here, there, reach, side = c("here"), c("there"), c("reach"), c("side")
    kind = lambda *names: c("sv_type").isin(*names)
    short, given = (side == "i") & kind("DUP"), kind("INS", "DEL")
    counts = _breakpoint_counts(reach, 2000, linked)
    # of short duplications in whole numbers: 0.7 times 90 is less than 63 in doubles
    grew = F.filter("r_inss", lambda o: (10 * o["n"] > 7 * size) & (o["n"] < 1.5 * size) & (_within(o["ref"] - 1, here, size) | _within(o["ref"] - 1, there, size)))
    fits = F.filter(F.when(side == "i", c("r_inss")).otherwise(c("r_dels")), lambda o: (o["n"] > 0.5 * size) & (o["n"] < 2 * size))
    own = F.filter("__fit", lambda o: _within(F.when(side == "i", o["ref"] - 1).when(side == "l", o["ref"]).otherwise(o["ref"] + o["n"] - 1), here, reach))
    whole = c("r_clip_l").isNull() & c("r_clip_r").isNull() & (c("r_start") + 1000 < here) & (c("r_last") + 1 - 1000 > here)
    either = lambda n: (_within(c(n), here, reach) | _within(c(n), there, reach)).cast("int")
    # reads without a quality have no say in both ends of duplications and inversions
    hits = hits.where(~kind("DUP", "INV") | short | F.coalesce(c("r_mapq") >= 0, F.lit(False))).withColumn("__fit", F.when(given, fits))
    counts = {
        "reads": F.lit(1), "near": F.when(kind("INV"), counts["near"]).otherwise(0), "clips": F.when(short, either("r_clip_l") + either("r_clip_r")).otherwise(counts["clips"]), "links": counts["links"],
        "events": F.when(short, F.size(grew)).when(given, F.size(own)).otherwise(0), "fitting": F.when(given, F.size("__fit")).otherwise(0), "whole": F.when(kind("INS") & whole, 1).otherwise(0), "quality": c("r_mapq"),
    }
    rows = hits.select("vid", c("r_sample").alias("sample"), "side", F.when(kind("TRA"), c("r_qname")).alias("__name"), *[n.cast("long").alias(name) for name, n in counts.items()])
    # rows of a translocation's names are added up in the tasks that meet them; other variants have one name
    of = lambda k, n: F.sum(F.when(side == k, c(n)).otherwise(0)).alias(f"{n}_{k}")
    names = rows.groupBy("vid", "sample", "__name").agg(*[of(k, n) for k in "ilr" for n in counts])
    both = c("__name").isNotNull() & (c("reads_l") > 0) & (c("reads_r") > 0)
    found = names.groupBy("vid", "sample").agg(F.count(F.when(both, 1)).alias("shared"), *[F.sum(f"{n}_{k}").alias(f"{n}_{k}") for k in "ilr" for n in counts])
    return found.withColumns({f"maq_{k}": F.ceil(F.try_divide(c(f"quality_{k}"), c(f"reads_{k}"))) for k in "ilr"}).drop(*[f"quality_{k}" for k in "ilr"])


def name_evidence(points: DataFrame, reads: DataFrame, clip_reach: Column, least_maq: int = 0) -> DataFrame:
    """Per translocation (both rows of breakpoints()) and sample: shared, names that both sides have; and of each side reads, near and
    clips as above, these two only of reads of least_maq, and maq. Rows of a name are added up in the tasks that meet them."""
    hits = _met(points, aligned(reads, 1), "low", "high")
    here, good = F.col("here"), F.col("r_mapq") >= least_maq
    near = good & (F.col("r_start") < here + clip_reach) & (F.col("r_last") >= F.greatest(here - clip_reach, F.lit(0)))
    counts = {"reads": F.lit(1), "good": good.cast("int"), "near": near.cast("int"), "clips": F.when(good, _clipped(here, clip_reach)).otherwise(0), "quality": F.col("r_mapq")}
    of = lambda k, c: F.sum(F.when(F.col("side") == k, c).otherwise(0))
    names = hits.groupBy("vid", F.col("r_sample").alias("sample"), "r_qname").agg(*[of(k, c).alias(f"{n}_{k}") for k in "lr" for n, c in counts.items()])
    both = (F.col("reads_l") > 0) & (F.col("reads_r") > 0)
    found = names.groupBy("vid", "sample").agg(F.count(F.when(both, 1)).alias("shared"), *[F.sum(f"{n}_{k}").alias(f"{n}_{k}") for k in "lr" for n in counts])
    return found.withColumns({f"maq_{k}": F.ceil(F.try_divide(F.col(f"quality_{k}"), F.col(f"reads_{k}"))) for k in "lr"}).drop("quality_l", "quality_r")


def small_duplication_evidence(variants: DataFrame, reads: DataFrame, shift: int = 500) -> DataFrame:
    """Per short duplication and sample: reads of it and shift around; events, insertions of 0.7 to 1.5 times the size within
    the size of its start or stop; clips, clipped ends within shift of either; maq."""
    size, start, stop = F.col("size"), F.col("start"), F.col("stop")
    near = variants.withColumns({"__low": F.greatest(start - shift, F.lit(0)), "__high": stop + shift - 1})
    hits = _met(near, aligned(reads, 1), "__low", "__high")
    # in whole numbers: 0.7 times 90 is less than 63 in doubles
    fits = lambda o: (10 * o["n"] > 7 * size) & (o["n"] < 1.5 * size) & (_within(o["ref"] - 1, start, size) | _within(o["ref"] - 1, stop, size))
    clipped = lambda c: (_within(F.col(c), start, F.lit(shift)) | _within(F.col(c), stop, F.lit(shift))).cast("int")
    return hits.groupBy("vid", F.col("r_sample").alias("sample")).agg(
        F.count(F.lit(1)).alias("reads"), F.sum(F.size(F.filter("r_inss", fits))).alias("events"), F.sum(clipped("r_clip_l") + clipped("r_clip_r")).alias("clips"), F.ceil(F.avg("r_mapq")).alias("maq"),
    )


def _asked(variants: DataFrame, samples: list[str]) -> DataFrame:
    return variants.select("vid", "sv_type", "size", F.explode(F.array(*map(F.lit, samples))).alias("sample"))


def _zero(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(0).cast("long"))


def _two_sided(asked: DataFrame, found: DataFrame, names: tuple[str, ...]) -> DataFrame:
    """asked with the counts of both sides (name_l and name_r), 0 where there are none."""
    side = lambda k: found.where(F.col("side") == k).select("vid", "sample", *[F.col(n).alias(f"{n}_{k}") for n in names])
    joined = asked.join(side("l"), ["vid", "sample"], "left").join(side("r"), ["vid", "sample"], "left")
    return joined.withColumns({f"{n}_{k}": _zero(f"{n}_{k}") for n in names for k in "lr"})


def _call(rows: DataFrame, gt: Column, reads: tuple[Column, Column], ratios: tuple[Column, Column], maq: Column) -> DataFrame:
    named = [c.cast("long").alias(f"reads_{k}") for k, c in zip("lr", reads)] + [c.cast("double").alias(f"ratio_{k}") for k, c in zip("lr", ratios)]
    return rows.select("vid", "sample", gt.alias("gt"), *named, maq.cast("long").alias("maq"))


def link_rate(links_l: Column, reads_l: Column, links_r: Column, reads_r: Column) -> Column:
    """Links of the left breakpoint over its reads, and those of both over the right one's."""
    return F.coalesce(F.try_divide(links_l, reads_l), F.lit(0.0)) + F.coalesce(F.try_divide(links_l + links_r, reads_r), F.lit(0.0))


Rule = tuple[Column, Column, tuple[Column, Column], tuple[Column, Column], Column]


def _pair_places(variants: DataFrame, reach: Column, clip_reach: Column, most_small: int = 3000) -> DataFrame:
    """Places for place_evidence(): short duplications with 500 bases around, both breakpoints of other pairs; of translocations reads
    within 500 and clips within 200."""
    c, pair = F.col, F.col("sv_type") == "TRA"
    short = (c("sv_type") == "DUP") & (c("size") <= most_small)
    two = breakpoints(variants.where(c("sv_type").isin("DUP", "INV", "TRA") & ~short), F.when(pair, 500).otherwise(reach)).withColumn("reach", F.when(pair, 200).otherwise(clip_reach).cast("long"))
    one = variants.where(short).select("vid", "sv_type", "size", F.lit("i").alias("side"), "chrom", c("start").alias("here"), c("stop").alias("there"), F.greatest(c("start") - 500, F.lit(0)).alias("low"), (c("stop") + 499).alias("high"), F.lit(500).cast("long").alias("reach"))
    return two.unionByName(one)


def _with_evidence(variants: DataFrame, samples: list[str], found: DataFrame, kinds: tuple[str, ...], turned: str = "reads") -> DataFrame:
    """Variants of these kinds in all samples with the counts of place_evidence(), 0 where there are none, and of each side the shares of reads
    with events or clips (cut; of inversions, over the count turned) and, to two places, with clips or of shared names (two). Shares are columns of their own:
    rules read them many times, and would be compiled with them each time."""
    c = F.col
    asked = _asked(variants, samples).where(c("sv_type").isin(*kinds) & ((c("sv_type") != "DUP") | c("size").isNotNull()))
    rows = asked.join(found, ["vid", "sample"], "left")
    rows = rows.withColumns({n: F.coalesce(c(n), F.lit(0)).cast("long") for n in found.columns if n not in ("vid", "sample")})
    kind = lambda *names: c("sv_type").isin(*names)
    over = lambda k: F.when(kind("INV"), c(f"{turned}_{k}")).otherwise(c(f"reads_{k}"))
    three = {f"cut_{k}": share(c(f"events_{k}") + c(f"clips_{k}"), over(k)) for k in "ilr"}
    two = {f"two_{k}": share(F.when(kind("TRA"), c("shared")).otherwise(c(f"clips_{k}")), c(f"reads_{k}"), 2) for k in "lr"}
    return rows.withColumns(three | two)


def _both(name: str) -> tuple[Column, Column]:
    return F.col(f"{name}_l"), F.col(f"{name}_r")


def _short_rule(most_small: int = 3000) -> Rule:
    """Short duplications: when it holds, genotype, reads, ratios, quality."""
    c = F.col
    gt = F.when(c("reads_i") == 0, MISSING).otherwise(by_one(c("cut_i"), "lr_dup_small"))
    return (c("sv_type") == "DUP") & (c("size") <= most_small), gt, (c("reads_i"), F.lit(0)), (c("cut_i"), F.lit(0.0)), c("maq_i")


def _long_duplication_rule() -> Rule:
    a, b = _both("two")
    gt = F.when(F.col("reads_l") + F.col("reads_r") == 0, MISSING).otherwise(by_two(a, b, "lr_dup"))
    return F.col("sv_type") == "DUP", gt, _both("reads"), (a, b), F.greatest("maq_l", "maq_r")


def _translocation_rule() -> Rule:
    (p, q), (x, y) = _both("two"), _both("cut")
    first = by_two(p, q, "lr_tra_names")
    gt = F.when(F.col("reads_l") + F.col("reads_r") == 0, MISSING).otherwise(F.when(first == HET, by_two(x, y, "lr_tra")).otherwise(first))
    return F.col("sv_type") == "TRA", gt, _both("reads"), (F.when(first == HET, x).otherwise(p), F.when(first == HET, y).otherwise(q)), F.greatest("maq_l", "maq_r")


def _ruled(rows: DataFrame, rules: list[Rule]) -> DataFrame:
    """Calls by the first rule that holds for a row."""

    def pick(values: list[Column], kind: str) -> Column:
        chosen = F.lit(None).cast(kind)
        for (holds, *_), value in reversed(list(zip(rules, values))):
            chosen = F.when(holds, value.cast(kind)).otherwise(chosen)
        return chosen

    reads = tuple(pick([r[2][k] for r in rules], "long") for k in (0, 1))
    ratios = tuple(pick([r[3][k] for r in rules], "double") for k in (0, 1))
    return _call(rows, pick([r[1] for r in rules], "string"), reads, ratios, pick([r[4] for r in rules], "long"))


def long_read_pair_calls(variants: DataFrame, reads: DataFrame, samples: list[str], most_small: int = 3000) -> DataFrame:
    """Genotypes of duplications, inversions and translocations (rows as for breakpoints()) from long reads, for every one of the samples.
    Duplications to most_small by insertions and clips of the whole region, longer ones by both breakpoints' clips; inversions by
    supplementary segments, undecided ones by clips; translocations by names, undecided ones by clips. None without reads."""
    c, size = F.col, F.col("size")
    half = F.ceil(size / 2)
    reach = lambda far: F.when(c("sv_type") == "DUP", 200).when(size < 1000, half).otherwise(far)
    found = breakpoint_evidence(_pair_places(variants, reach(1000), reach(500), most_small), reads, c("reach"), linked=("INV",), wide=True)
    rows = _with_evidence(variants, samples, found, ("DUP", "INV", "TRA"), "near")
    rate = link_rate(c("links_l"), c("reads_l"), c("links_r"), c("reads_r"))
    rows, rate = rows.withColumn("rate", rate), c("rate")
    open_, (x, y) = (rate > 0) & (rate / 4 < 0.75), _both("cut")
    none = c("reads_l") + c("reads_r") == 0
    gt = F.when(none | (open_ & (c("near_l") + c("near_r") == 0)), MISSING).otherwise(inversion(rate, x, y))
    counted = tuple(F.when(open_, c(f"near_{k}")).otherwise(c(f"reads_{k}")) for k in "lr")
    turned = (c("sv_type") == "INV", gt, counted, (F.when(open_, x).otherwise(rate), F.when(open_, y).otherwise(rate)), F.greatest("maq_l", "maq_r"))
    return _ruled(rows, [_short_rule(most_small), _long_duplication_rule(), turned, _translocation_rule()])


def short_read_pair_calls(variants: DataFrame, reads: DataFrame, samples: list[str], shift: int = 30, least_maq: int = 1) -> DataFrame:
    """The same from short reads: by clips at both breakpoints, translocations by names first."""
    c, asked = F.col, _asked(variants, samples)
    both = F.col("sv_type").isin("DUP", "INV")
    found = breakpoint_evidence(breakpoints(variants.where(both), F.lit(shift)), reads, F.lit(shift), least_maq=least_maq)
    two = _two_sided(asked.where(both), found, ("reads", "clips", "maq"))
    a, b = (share(c(f"clips_{k}"), c(f"reads_{k}")) for k in "lr")
    gt = F.when(c("reads_l") + c("reads_r") == 0, MISSING).when(c("sv_type") == "DUP", by_two(a, b, "sr_dup")).otherwise(by_two(a, b, "sr_inv"))
    clipped = _call(two, gt, (c("reads_l"), c("reads_r")), (a, b), F.greatest("maq_l", "maq_r"))
    names = name_evidence(breakpoints(variants.where("sv_type = 'TRA'"), F.lit(shift)), reads, F.lit(shift), least_maq)
    tra = asked.where("sv_type = 'TRA'").join(names, ["vid", "sample"], "left")
    p, q = (share(_zero("shared"), _zero(f"reads_{k}"), 2) for k in "lr")
    x, y = (share(_zero(f"clips_{k}"), _zero(f"good_{k}")) for k in "lr")
    sure = by_two(p, q, "lr_tra_names") == HOM
    gt = F.when(sure, HOM).when(_zero("good_l") + _zero("good_r") == 0, MISSING).otherwise(short_translocation(_zero("shared"), _zero("reads_l"), _zero("reads_r"), x, y))
    counted = tuple(F.when(sure, _zero(f"reads_{k}")).otherwise(_zero(f"good_{k}")) for k in "lr")
    return clipped.unionByName(_call(tra, gt, counted, (F.when(sure, p).otherwise(x), F.when(sure, q).otherwise(y)), F.greatest(_zero("maq_l"), _zero("maq_r"))))


def assembly_pair_calls(variants: DataFrame, reads: DataFrame, samples: list[str], shift: int = 100, least_maq: int = 50) -> DataFrame:
    """The same from aligned contigs: duplications by clips and insertions of contigs of least_maq, the others by supplementary segments."""
    c, asked = F.col, _asked(variants, samples)
    dups = breakpoint_evidence(breakpoints(variants.where("sv_type = 'DUP'"), F.lit(shift)), reads, F.lit(200), least_maq=least_maq)
    two = _two_sided(asked.where("sv_type = 'DUP'"), dups, ("reads", "clips", "grown", "maq"))
    a, b = (share(c(f"clips_{k}") + c(f"grown_{k}"), c(f"reads_{k}")) for k in "lr")
    none = c("reads_l") + c("reads_r") == 0
    out = _call(two, F.when(none, MISSING).otherwise(by_two(a, b, "cr_dup")), (c("reads_l"), c("reads_r")), (a, b), F.greatest("maq_l", "maq_r"))
    for kind, reach in (("INV", 800), ("TRA", 2000)):
        found = breakpoint_evidence(breakpoints(variants.where(F.col("sv_type") == kind), F.lit(shift)), reads, F.lit(shift), reach)
        two = _two_sided(asked.where(F.col("sv_type") == kind), found, ("reads", "links", "maq"))
        rate = link_rate(c("links_l"), c("reads_l"), c("links_r"), c("reads_r"))
        out = out.unionByName(_call(two, F.when(none, MISSING).otherwise(by_one(rate, "cr_sa")), (c("reads_l"), c("reads_r")), (rate, rate), F.greatest("maq_l", "maq_r")))
    return out


def _ends(variants: DataFrame, shift: int) -> DataFrame:
    """Insertions (side i) and both ends of deletions (l and r) with here, their place, and __low to __high, the places within shift."""
    side, start, stop = F.col("side"), F.col("start"), F.col("stop")
    ends = F.when(F.col("sv_type") == "INS", F.array(F.lit("i"))).when(F.col("sv_type") == "DEL", F.array(F.lit("l"), F.lit("r")))
    here = F.when(side == "r", stop).otherwise(start)
    rows = variants.where(F.col("sv_type").isin("INS", "DEL")).select("vid", "chrom", "start", "stop", "size", "sv_type", F.explode(ends).alias("side"))
    return rows.withColumns({"here": here, "__low": F.greatest(here - shift, F.lit(0)), "__high": F.when(side == "i", stop).otherwise(here) + shift - 1})


def _local(near: DataFrame, reads: DataFrame, fits: Callable[[Column], Column], inside: Callable[[Column], Column], clipped: Callable[[Column], Column], whole: Column, points: Column | None = None) -> DataFrame:
    """near: rows of _ends(), and with points rows of side m, the stretches in which these lie. Per vid and sample, of each side k: reads_k;
    fitting_k, operations of the side's kind that fit; events_k, those inside; places_k, distinct ones of these; clips_k, clipped ends that clipped() takes;
    whole_k, reads without clips for which whole holds; maq_k; and covered, points whose 7 bases a read touches. One interval join serves all of them."""
    hits = _met(near, aligned(reads, 1), "__low", "__high")
    side, insert = F.col("side"), F.col("side") == "i"
    hits = hits.withColumn("__fit", F.when(side != "m", F.filter(F.when(insert, F.col("r_inss")).otherwise(F.col("r_dels")), fits)))
    unclipped = F.col("r_clip_l").isNull() & F.col("r_clip_r").isNull()
    taken = lambda n: F.coalesce(clipped(F.col(n)), F.lit(False)).cast("int")
    bit = lambda p, k: F.when((F.col("r_start") <= p + 6) & (F.col("r_last") >= p), F.call_function("shiftleft", F.lit(1), k)).otherwise(0)
    marks = F.lit(0) if points is None else F.when(side == "m", F.aggregate(F.transform(points, bit), F.lit(0), lambda a, m: a.bitwiseOR(m))).otherwise(0)
    rows = hits.select("vid", "side", F.col("r_sample").alias("sample"), "r_mapq", F.size(F.coalesce("__fit", F.array())).alias("fits"), (taken("r_clip_l") + taken("r_clip_r")).alias("cut"), (unclipped & whole).alias("whole"), marks.alias("marks"), F.posexplode_outer(F.filter("__fit", inside)).alias("k", "o"))
    first = F.coalesce(F.col("k"), F.lit(0)) == 0
    place = F.struct(F.col("o.ref").alias("ref"), F.when(~insert, F.col("o.n")).alias("n"))
    found = rows.groupBy("vid", "sample", "side").agg(
        F.count(F.when(first, 1)).alias("reads"), F.coalesce(F.sum(F.when(first, F.col("fits"))), F.lit(0)).alias("fitting"), F.count("o").alias("events"), F.count_distinct(F.when(F.col("o").isNotNull(), place)).alias("places"),
        F.coalesce(F.sum(F.when(first, F.col("cut"))), F.lit(0)).alias("clips"), F.count(F.when(first & F.col("whole"), 1)).alias("whole"), F.ceil(F.avg(F.when(first, F.col("r_mapq")))).alias("maq"), F.bit_or("marks").alias("marks"),
    )
    # all sides of a variant and sample in one row, so the evidence is joined to the variants once
    names = ("reads", "fitting", "events", "places", "clips", "whole", "maq")
    return found.groupBy("vid", "sample").agg(*[F.max(F.when(side == k, F.col(n))).alias(f"{n}_{k}") for k in "ilr" for n in names], F.bit_count(F.max("marks")).alias("covered"))


def _ends_evidence(variants: DataFrame, samples: list[str], found: DataFrame, support: Callable[[str], Column]) -> tuple[DataFrame, list[Column]]:
    """Insertions and deletions in all samples with the counts of _local(), 0 where there are none, and of each side the share of reads
    that support() is. Shares are columns of their own: rules read them many times, and would be compiled with them each time."""
    rows = _asked(variants, samples).where(F.col("sv_type").isin("INS", "DEL")).join(found, ["vid", "sample"], "left")
    rows = rows.withColumns({n: F.coalesce(F.col(n), F.lit(0)).cast("long") for n in found.columns if n not in ("vid", "sample")})
    rows = rows.withColumns({f"share_{k}": share(support(k), F.col(f"reads_{k}")) for k in "ilr"})
    return rows, [F.col(f"share_{k}") for k in "ilr"]


def _call_ends(rows: DataFrame, gt: tuple[Column, Column], ratio: Column, ratios: tuple[Column, Column]) -> DataFrame:
    """Calls of rows of _ends_evidence(); gt: of insertions and of deletions; ratio of insertions, ratios of deletions."""
    c, pick = F.col, lambda one, two: F.when(F.col("sv_type") == "INS", one).otherwise(two)
    reads = (pick(c("reads_i"), c("reads_l")), pick(F.lit(0).cast("long"), c("reads_r")))
    return _call(rows, pick(*gt), reads, (pick(ratio, ratios[0]), pick(F.lit(0.0), ratios[1])), pick(c("maq_i"), F.greatest("maq_l", "maq_r")))


def short_read_calls(variants: DataFrame, reads: DataFrame, samples: list[str], shift: int = 30, span: int = 50, least_maq: int = 1, homo: float = 0.65, ref: float = 0.05) -> DataFrame:
    """Genotypes of insertions and deletions (vid, chrom, start, stop, size, sv_type) from short reads, for every one of the samples. Operations
    within 5 bases of the size count, the first of each place twice; reads across without clips, less such operations, correct calls;
    deletions of which two of six interior windows at least have no reads are homozygous."""
    c, size, start, stop, here, side = F.col, F.col("size"), F.col("start"), F.col("stop"), F.col("here"), F.col("side")
    at = lambda p, place, after: (p >= place - shift) & (p < place + after)
    insert = side == "i"
    near = _ends(variants, shift)
    # the reads of the interior windows: those that touch the stretch from the first to the last
    inner = near.where("side = 'l'").withColumns({"side": F.lit("m"), "__low": F.array_min(interior_points(start, stop)), "__high": F.array_max(interior_points(start, stop)) + 6})
    begins, ends = c("r_start"), c("r_last") + 1
    inside = lambda o: F.when(insert, at(o["ref"] - 1, start, 120) & at(o["ref"], stop, 120)).otherwise(at(F.when(side == "l", o["ref"]).otherwise(o["ref"] + o["n"] - 1), here, shift))
    clipped = lambda p: F.when(insert, at(p, start, 120) & at(p, stop, 120)).otherwise(at(p, here, shift))
    passes = F.when(insert | (size >= 100), (begins + span < here) & (ends - span > here)).otherwise((begins - 10 < start) & (ends - 10 > stop))
    found = _local(near.unionByName(inner), reads.where(c("mapq") >= least_maq), lambda o: (o["n"] >= size - 5) & (o["n"] <= size + 5), inside, clipped, passes, interior_points(start, stop))
    rows, (x, a, b) = _ends_evidence(variants, samples, found, lambda k: c(f"events_{k}") + c(f"places_{k}") + c(f"clips_{k}"))
    one = short_insertion(x, c("reads_i"), c("whole_i") - c("fitting_i"), homo, ref)
    spans = c("whole_l") + c("whole_r") - c("fitting_l") - c("fitting_r")
    two = short_deletion(F.greatest(a, b), c("reads_l") + c("reads_r"), spans, 6 - c("covered"), homo, ref)
    return _call_ends(rows, (one, two), x, (a, b))


def assembly_calls(variants: DataFrame, reads: DataFrame, samples: list[str], shift: int = 100, reach: int = 200, least_maq: int = 50) -> DataFrame:
    """The same from aligned contigs: insertions over 40 bases, deletions of 40 at least, and clips, within reach of the places."""
    start, stop, here, side, c = F.col("start"), F.col("stop"), F.col("here"), F.col("side"), F.col
    at = lambda p, place: (p >= place - reach) & (p < place + reach)
    insert = side == "i"
    inside = lambda o: F.when(insert, at(o["ref"] - 1, start) & at(o["ref"], stop)).otherwise(at(F.when(side == "l", o["ref"]).otherwise(o["ref"] + o["n"] - 1), here))
    clipped = lambda p: F.when(insert, at(p, start) & at(p, stop)).otherwise(at(p, here))
    found = _local(_ends(variants, shift), reads.where(c("mapq") >= least_maq), lambda o: (o["n"] > 40) | (~insert & (o["n"] == 40)), inside, clipped, F.lit(False))
    rows, (x, a, b) = _ends_evidence(variants, samples, found, lambda k: c(f"events_{k}") + c(f"clips_{k}"))
    one = F.when(c("reads_i") == 0, MISSING).otherwise(by_one(x, "cr"))
    two = F.when(c("reads_l") + c("reads_r") == 0, MISSING).otherwise(by_one(F.greatest(a, b), "cr"))
    return _call_ends(rows, (one, two), x, (a, b))


def uncovered_points(deletions: DataFrame, coverage: DataFrame, ident: list[str]) -> DataFrame:
    """deletions with the number of their six interior points that no interval covers."""
    points = deletions.select(*ident, "chrom", F.explode(interior_points(F.col("start"), F.col("stop"))).alias("point"))
    counted = count_overlaps(points, coverage, [*ident, "point"], "n", None, ("chrom", "point", "point"))
    empty = counted.groupBy(*ident).agg(F.count(F.when(F.col("n") == 0, 1)).alias("empty_points"))
    return deletions.join(empty, ident, "left")


def forced_insertion(events: Column, clips: Column, reads: Column, spans: Column, fitting: Column, size: Column, homo: float = 0.75, ref: float = 0.05) -> Column:
    """Given insertions: reads across at a tenth of all and one correct a homozygous call; short ones need a fitting operation."""
    first = by_depth(events + clips, reads, homo, ref)
    second = F.when((first == HOM) & (F.floor(0.1 * reads) + 1 <= spans), HET).otherwise(first)
    return F.when(reads == 0, MISSING).when((second != REF) & (size < 800) & (fitting == 0), REF).otherwise(second)


def forced_calls(variants: DataFrame, reads: DataFrame, samples: list[str], shift: int = 100, homo: float = 0.75, ref: float = 0.05) -> DataFrame:
    """Genotypes of given variants of every type (as readers.user_variants() has them, with vid and size; rows as for breakpoints()) from long
    reads, for every one of the samples. Each operation of more than half and less than twice the size counts, none adds up with others: of
    insertions within the size, 500 at most, of the start; of deletions within 200 of either end, where the end of more support
    decides, of equal ones the second. Inversions go by clips alone; long duplications by the clips within shift of their ends; short duplications and
    translocations as in long_read_pair_calls()."""
    c, size = F.col, F.col("size")
    half = F.when(c("sv_type") == "DUP", shift).when(size < 1000, F.ceil(size / 2)).otherwise(500)
    ends = _ends(variants, shift).select("vid", "sv_type", "size", "side", "chrom", "here", c("stop").alias("there"), c("__low").alias("low"), c("__high").alias("high"), F.when(c("side") == "i", F.least(size, F.lit(500))).otherwise(200).cast("long").alias("reach"))
    found = breakpoint_evidence(_pair_places(variants, half, half).unionByName(ends), reads, c("reach"), linked=(), wide=True)
    rows = _with_evidence(variants, samples, found, ("INS", "DEL", "DUP", "INV", "TRA"))
    one = forced_insertion(c("events_i"), c("clips_i"), c("reads_i"), c("whole_i") - c("fitting_i"), c("fitting_i"), size, homo, ref)
    inserted = (c("sv_type") == "INS", one, (c("reads_i"), F.lit(0)), (c("cut_i"), F.lit(0.0)), c("maq_i"))
    none, maq = c("reads_l") + c("reads_r") == 0, F.greatest("maq_l", "maq_r")
    n = {k: c(f"events_{k}") + c(f"clips_{k}") for k in "lr"}
    two = by_depth(F.greatest(n["l"], n["r"]), F.when(n["l"] > n["r"], c("reads_l")).otherwise(c("reads_r")), homo, ref)
    two = F.when((two != REF) & (size < 1000) & (c("fitting_l") + c("fitting_r") == 0), REF).otherwise(two)
    deleted = (c("sv_type") == "DEL", F.when(none, MISSING).otherwise(two), _both("reads"), _both("cut"), maq)
    a, b = _both("cut")
    turned = (c("sv_type") == "INV", F.when(none, MISSING).otherwise(by_two(a, b, "force_inv")), _both("reads"), (a, b), maq)
    return _ruled(rows, [inserted, deleted, _short_rule(), _long_duplication_rule(), turned, _translocation_rule()])
