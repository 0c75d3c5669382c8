"""CIGAR strings, clips, split reads: the columns and tables that signals come from."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

OPERATION = "([0-9]+)([MIDNSHP=X])"


def operations(cigar: Column) -> Column:
    """Array of (n, op), in order."""
    whole = F.regexp_extract_all(cigar, F.lit(OPERATION), F.lit(0))
    return F.transform(whole, lambda o: F.struct(F.substring(o, F.lit(1), F.length(o) - 1).cast("long").alias("n"), F.substring(o, F.length(o), F.lit(1)).alias("op")))


def _sum(cigar: Column, kinds: str) -> Column:
    """Bases of the operations of these kinds."""
    return F.aggregate(F.regexp_extract_all(cigar, F.lit(f"([0-9]+)[{kinds}]"), F.lit(1)), F.lit(0).cast("long"), lambda a, n: a + n.cast("long"))


def mapped_length(cigar: Column) -> Column:
    """Mapped bases, insertions counted and deletions not."""
    return _sum(cigar, "MNP=XI")


def clips(cigar: Column) -> Column:
    """(left, mapped, right): clip lengths at both ends and mapped length, insertions counted and deletions not."""
    ops = operations(cigar)
    end = lambda o: F.when(o["op"].isin("S", "H"), o["n"]).otherwise(F.lit(0).cast("long"))
    right = F.when(F.size(ops) > 1, end(F.element_at(ops, -1))).otherwise(F.lit(0).cast("long"))
    return F.struct(F.coalesce(end(F.get(ops, F.lit(0))), F.lit(0)).alias("left"), mapped_length(cigar).alias("mapped"), F.coalesce(right, F.lit(0)).alias("right"))


def reference_length(cigar: Column) -> Column:
    return _sum(cigar, "MDN=X")


def placed(cigar: Column, pos: Column, loose: bool = False) -> Column:
    """Array of (n, op, ref, query): operations with the reference and query places at which they begin.
    loose counts only M and D on the reference."""
    moves_ref = ("M", "D") if loose else ("M", "D", "N", "=", "X")
    moves_query = ("M", "I", "S", "=", "X")
    start = F.struct(pos.cast("long").alias("ref"), F.lit(0).cast("long").alias("query"), F.array().cast("array<struct<n:bigint,op:string,ref:bigint,query:bigint>>").alias("out"))

    def step(a: Column, o: Column) -> Column:
        return F.struct(
            (a["ref"] + F.when(o["op"].isin(*moves_ref), o["n"]).otherwise(0)).alias("ref"),
            (a["query"] + F.when(o["op"].isin(*moves_query), o["n"]).otherwise(0)).alias("query"),
            F.array_append(a["out"], F.struct(o["n"].alias("n"), o["op"].alias("op"), a["ref"].alias("ref"), a["query"].alias("query"))).alias("out"),
        )

    return F.aggregate(operations(cigar), start, step, lambda a: a["out"])


def cigar_signals(reads: DataFrame, least: int = 40, shifted: bool = False) -> DataFrame:
    """Deletions and insertions of at least least bases inside alignments; insertions carry their sequence
    (shifted: without its first and last base, an older convention)."""
    sequence = F.expr("substring(seq, o.query + 2, o.n - 2)" if shifted else "substring(seq, o.query + 1, o.n)")
    wanted = F.filter(placed(F.col("cigar"), F.col("pos")), lambda o: o["op"].isin("D", "I") & (o["n"] >= least))
    found = reads.withColumn("o", F.explode(wanted))
    deletion = F.col("o.op") == "D"
    stop = F.when(deletion, F.col("o.ref") + F.col("o.n") - 1).otherwise(F.col("o.ref") + 1)
    kind = F.when(deletion, "DEL").otherwise("INS")
    return found.select(
        F.col("rname").alias("chrom"), F.col("qname").alias("query_name"), F.col("o.ref").alias("start"), stop.alias("stop"), F.col("o.n").alias("sv_len"), F.col("mapq").alias("maq"),
        F.concat_ws("", "rname", F.lit(":"), "o.ref", F.lit("-"), stop, F.lit("_"), kind, F.lit("="), "o.n").alias("svid"), kind.alias("sv_type"),
        F.when(deletion, "*").otherwise(sequence).alias("seq"),
    )


def clip_breakpoints(reads: DataFrame, least: int = 500) -> DataFrame:
    """Places at which at least least bases are clipped."""
    wanted = F.filter(placed(F.col("cigar"), F.col("pos")), lambda o: o["op"].isin("S", "H") & (o["n"] >= least))
    return reads.select(F.col("qname").alias("query_name"), "flag", F.col("rname").alias("chrom"), F.explode(wanted).alias("o")).select("query_name", "flag", "chrom", F.col("o.ref").alias("pos"))


def clip_ends(reads: DataFrame) -> DataFrame:
    """One row per clipped end of a read: chrom, pos, side, query_name."""
    c = clips(F.col("cigar"))
    ends = F.array(
        F.when(c["left"] > 0, F.struct(F.col("pos").alias("pos"), F.lit("left").alias("side"))),
        F.when(c["right"] > 0, F.struct((F.col("pos") + reference_length(F.col("cigar"))).alias("pos"), F.lit("right").alias("side"))),
    )
    return reads.select(F.col("qname").alias("query_name"), F.col("rname").alias("chrom"), F.explode(F.filter(ends, lambda e: e.isNotNull())).alias("e")).select("query_name", "chrom", "e.pos", "e.side")


def breakpoint_histogram(reads: DataFrame) -> DataFrame:
    return clip_ends(reads).groupBy("chrom", "pos").agg(F.count(F.lit(1)).alias("n"))


def sa_segments(sa: Column) -> Column:
    """Array of (chrom, pos, strand, cigar, mapq) of an SA tag."""
    parts = F.transform(F.filter(F.split(sa, ";"), lambda p: p != ""), lambda p: F.split(p, ","))
    part = lambda p, k: F.get(p, F.lit(k))
    return F.transform(parts, lambda p: F.struct(part(p, 0).alias("chrom"), part(p, 1).cast("long").alias("pos"), part(p, 2).alias("strand"), part(p, 3).alias("cigar"), part(p, 4).cast("int").alias("mapq")))


def segments(reads: DataFrame) -> DataFrame:
    """One row per aligned piece of a read: from its own line and from its SA tag (primary lines only), once each.
    A tag's position counts from 1 and its end omits deletions, as the tag's users take it; own lines count from 0."""
    own = reads.select("qname", "flag", F.col("rname").alias("chrom"), F.col("pos").alias("start"), (F.col("pos") + reference_length(F.col("cigar"))).alias("stop"), clips(F.col("cigar")).alias("clip"), "mapq")
    tag = reads.where(F.col("sa").isNotNull() & (F.col("flag").bitwiseAND(2048) == 0)).select("qname", F.explode(sa_segments(F.col("sa"))).alias("s"))
    other = tag.select(
        "qname", (F.lit(2048) + F.when(F.col("s.strand") == "-", 16).otherwise(0)).alias("flag"), F.col("s.chrom").alias("chrom"), F.col("s.pos").alias("start"),
        (F.col("s.pos") + clips(F.col("s.cigar"))["mapped"]).alias("stop"), clips(F.col("s.cigar")).alias("clip"), F.col("s.mapq").alias("mapq"),
    )
    return own.where(F.col("flag").bitwiseAND(2048) == 0).unionByName(other)


def is_reverse(flag: Column) -> Column:
    return flag.bitwiseAND(16) != 0


def segment_pairs(segs: DataFrame, assembly: bool = False, least: int | None = None) -> DataFrame:
    """Per read each primary p with each other piece q, and both by start: l, r; of equal starts the primary is
    right. Assemblies take the piece of smallest chromosome and position as primary, whatever its flag, where one is no supplement; other
    pieces than the primary of under 300 (250) mapped bases don't count."""
    least = least if least is not None else 250 if assembly else 300
    enough = F.col("clip.mapped") >= least
    if assembly:
        # equal places go by clips and quality, so that reruns take the same piece
        by = Window.partitionBy("qname").orderBy("chrom", "start", "flag", "stop", *[c for c in ("clip", "mapq") if c in segs.columns])
        first = segs.withColumns({"__k": F.row_number().over(by), "__own": F.min("flag").over(Window.partitionBy("qname"))}).where("__own <= 16").drop("__own")
        p, q = first.where("__k = 1").drop("__k"), first.where((F.col("__k") > 1) & enough).drop("__k")
    else:
        p, q = segs.where("flag <= 16"), segs.where((F.col("flag") > 16) & enough)
    names = [c for c in segs.columns if c != "qname"]
    packed = lambda df, n: df.select("qname", F.struct(*names).alias(n))
    pairs = packed(p, "p").join(packed(q, "q"), "qname")
    ahead = F.col("q.start") > F.col("p.start")
    left, right = F.when(ahead, F.col("p")).otherwise(F.col("q")), F.when(ahead, F.col("q")).otherwise(F.col("p"))
    return pairs.select("qname", left.alias("l"), right.alias("r"), "p", "q")


#: Cells of the places that a rule compares.
CELL = 2048
#: Pieces up to which a contig's pairs are made from its name alone.
FEW = 64


def banded_pairs(segs: DataFrame, least: int = 250, kind: str | None = None) -> DataFrame:
    """Pairs of a read's or contig's pieces, each once as primary, that a rule of split_signals() or translocation_signals() can
    take: qname, l, r, and p, q (the same). Pieces of a contig of few ones meet by its name. Of others every rule bounds the
    distance of two places, on the read or on the chromosome, so pieces meet in cells of those places and a contig of many pieces is
    many keys; a pair that several rules bring together is kept at the first. Equal pieces are one; of a pair one, of equal starts the left, has least mapped bases.
    Of pieces of equal starts both orders are pairs. kind: same (pairs on one chromosome) or other (on two), both by default."""
    names = [c for c in segs.columns if c != "qname"]
    own = segs.select("qname", F.struct(*names).alias("s"))
    query_stop = lambda s: s["clip"]["left"] + s["clip"]["mapped"]
    back_stop = lambda s: s["clip"]["mapped"] + s["clip"]["right"]
    # place of the left piece, place of the right one, least and largest distance of these
    same = [
        (query_stop, lambda s: s["clip"]["left"], -1499, 199), (lambda s: s["stop"], lambda s: s["start"], -300, 300), (lambda s: s["clip"]["left"], query_stop, -199, 499),
        (lambda s: s["clip"]["right"], query_stop, -199, 499), (lambda s: s["clip"]["left"], back_stop, -199, 499),
    ]
    other = [((lambda s, side=side: s["clip"][side]), end, -500, 500) for side in ("left", "right") for end in (query_stop, back_stop)]

    # contigs of many rows are few, whatever the table, and lose equal ones before they move; all others move once, by name
    many = segs.groupBy("qname").agg(F.count(F.lit(1)).alias("__n")).where(F.col("__n") > FEW).select("qname")
    some = bool(many.head(1))
    short, long = (own.join(many, "qname", "left_anti"), own.join(many, "qname", "left_semi").distinct()) if some else (own, None)
    short = short.repartition("qname").distinct()

    def held(rules: list) -> list[Column]:
        return [(b(F.col("r")) - a(F.col("l"))).between(low, high) for a, b, low, high in rules]

    def named(rules: list, on: Column, ordered: Column) -> DataFrame:
        near = F.lit(False)
        for h in held(rules):
            near = near | h
        left, right = (short.select("qname", F.col("s").alias(k)).hint("merge") for k in "lr")
        return left.join(right, "qname").where(on & ordered & near).select("qname", "l", "r", F.col("l").alias("p"), F.col("r").alias("q"))

    def celled(rules: list, on: Column, ordered: Column) -> DataFrame:
        cell = lambda x: F.floor(x / CELL)
        lefts = F.array(*[F.struct(F.lit(k).alias("rule"), (a(F.col("l")) + low).alias("low"), (a(F.col("l")) + high).alias("high")) for k, (a, _, low, high) in enumerate(rules)])
        rights = F.array(*[F.struct(F.lit(k).alias("rule"), cell(b(F.col("r"))).alias("cell")) for k, (_, b, _, _) in enumerate(rules)])
        left = long.select("qname", F.col("s").alias("l")).withColumn("e", F.explode(lefts)).select("qname", "l", F.col("e.rule").alias("rule"), F.explode(F.sequence(cell(F.col("e.low")), cell(F.col("e.high")))).alias("cell"))
        right = long.select("qname", F.col("s").alias("r")).withColumn("e", F.explode(rights)).select("qname", "r", "e.rule", "e.cell")
        holds = held(rules)
        first = F.lit(False)
        for k in range(len(rules)):
            earlier = F.lit(True)
            for h in holds[:k]:
                earlier = earlier & ~h
            first = first | ((F.col("rule") == k) & holds[k] & earlier)
        return left.join(right, ["qname", "rule", "cell"]).where(on & ordered & first).select("qname", "l", "r", F.col("l").alias("p"), F.col("r").alias("q"))

    def met(rules: list, on: Column, ordered: Column) -> DataFrame:
        found = named(rules, on, ordered)
        return found.unionByName(celled(rules, on, ordered)) if some else found

    l, r = F.col("l"), F.col("r")
    big = (l["clip"]["mapped"] >= least) | (r["clip"]["mapped"] >= least)
    along = ((l["start"] < r["start"]) & big) | ((l["start"] == r["start"]) & (l != r) & (l["clip"]["mapped"] >= least))
    pairs = {"same": lambda: met(same, l["chrom"] == r["chrom"], along), "other": lambda: met(other, l["chrom"] < r["chrom"], big)}
    return pairs["same"]().unionByName(pairs["other"]()) if kind is None else pairs[kind]()


def split_signals(pairs: DataFrame, min_mapq: int = 30, exact_mapq: int | None = None, min_size: int = 40, max_size: int = 10_000_000, seq: Column | None = None) -> DataFrame:
    """Signals of pairs on one chromosome: DEL, INS, DUP (by either overlap) on one strand, INV (by ends or starts) on two.
    Stops follow from starts and sizes. seq: the primary's sequence, of which insertions carry their part."""
    l, r = F.col("l"), F.col("r")
    sh1, len1, sh2 = l["clip"]["left"], l["clip"]["mapped"], l["clip"]["right"]
    sh3, len2, sh4 = r["clip"]["left"], r["clip"]["mapped"], r["clip"]["right"]
    maq = F.floor((l["mapq"] + r["mapq"]) / 2)
    same = is_reverse(l["flag"]) == is_reverse(r["flag"])
    turned = ~same & (l["start"] < r["start"]) & (r["stop"] - l["stop"] > -200)
    lap1, lap2 = sh1 + len1 - sh3, sh3 + len2 - sh1
    gap = r["start"] - l["stop"]
    del_size = gap + lap1
    del_start = F.greatest(F.lit(0), l["stop"] - F.greatest(F.lit(0), lap1))
    ins_size = sh3 - len1 - sh1 - gap
    back, whole = l["stop"] - r["start"], r["stop"] - l["start"]
    inv1, inv2 = sh3 + len2 - sh2, sh4 + len2 - sh1
    ends, starts = r["stop"] - l["stop"], r["start"] - l["start"]
    inserted = F.lit("*") if seq is None else F.coalesce(F.substring(seq, (sh1 + len1 + 1).cast("int"), F.greatest(F.lit(0), sh3 - gap - sh1 - len1).cast("int")), F.lit("*"))

    def made(when: Column, kind: str, start: Column, size: Column, length: Column | None = None, text: Column | None = None) -> Column:
        fits = when & (size >= min_size) & (size <= max_size)
        stop = start + (size if length is None else length)
        return F.when(fits, F.struct(F.lit(kind).alias("sv_type"), start.cast("long").alias("start"), stop.cast("long").alias("stop"), size.cast("long").alias("sv_len"), (F.lit("*") if text is None else text).alias("seq")))

    found = F.array(
        made(same & (lap1 > -200) & (lap1 < 1500), "DEL", del_start, del_size, del_size - 1),
        made(same & (F.abs(gap) <= 300), "INS", F.least(r["start"], l["stop"]), ins_size, F.lit(1), inserted),
        made(same & (lap1 > -200) & (lap1 < 500) & (back >= F.greatest(F.lit(50), lap1)), "DUP", r["start"], back - F.greatest(lap1, F.lit(0))),
        made(same & (lap2 > -200) & (lap2 < 500) & (whole >= F.greatest(F.lit(1000), lap2)), "DUP", l["start"], whole - lap2),
        made(turned & (inv1 > -200) & (inv1 < 500) & (ends > F.greatest(F.lit(100), inv1)), "INV", l["stop"], ends - inv1),
        made(turned & (inv2 > -200) & (inv2 < 500) & (starts >= F.greatest(F.lit(100), inv2)), "INV", l["start"], starts - inv2),
    )
    good = maq >= min_mapq if exact_mapq is None else maq == exact_mapq
    out = pairs.where((l["chrom"] == r["chrom"]) & good).select("qname", l["chrom"].alias("chrom"), maq.cast("int").alias("maq"), F.explode(F.filter(found, lambda s: s.isNotNull())).alias("s"))
    return out.select(
        "chrom", F.col("qname").alias("query_name"), "s.start", "s.stop", "s.sv_len", "maq",
        F.concat_ws("", "chrom", F.lit(":"), "s.start", F.lit("-"), "s.stop", F.lit("_"), "s.sv_type", F.lit("LEN="), "s.sv_len").alias("svid"), "s.sv_type", "s.seq",
    )


def translocation_signals(pairs: DataFrame, chroms: DataFrame, mapq: int = 60, reach: int = 500) -> DataFrame:
    """Signals of pairs on two chromosomes, both sides ordered as chroms (chrom, rank; one row a chromosome) has them.
    Each piece breaks at its start if its left clip is as long as the other's mapped part with a clip, else at its stop
    if its right clip is; both must break; mean quality, rounded down, exactly mapq."""
    p, q = F.col("p"), F.col("q")

    def breaks(own: Column, other: Column) -> Column:
        c, d = own["clip"], other["clip"]
        near = lambda side: (F.abs(c[side] - d["left"] - d["mapped"]) <= reach) | (F.abs(c[side] - d["mapped"] - d["right"]) <= reach)
        return F.when(near("left"), own["start"]).when(near("right"), own["stop"])

    both = (p["chrom"] != q["chrom"]) & (F.floor((p["mapq"] + q["mapq"]) / 2) == mapq)
    rows = pairs.where(both).select("qname", p["chrom"].alias("a"), q["chrom"].alias("b"), breaks(p, q).alias("x"), breaks(q, p).alias("y")).where("x is not null and y is not null")
    order = chroms.select("chrom", "rank")
    ranked = rows.join(order.withColumnsRenamed({"chrom": "a", "rank": "ra"}), "a").join(order.withColumnsRenamed({"chrom": "b", "rank": "rb"}), "b")
    swap = F.col("ra") > F.col("rb")
    pick = lambda c, d: F.when(swap, F.col(d)).otherwise(F.col(c))
    out = ranked.select(pick("a", "b").alias("chrom"), F.col("qname").alias("query_name"), pick("x", "y").alias("start"), pick("b", "a").alias("chrom2"), pick("y", "x").alias("start2"), F.lit(mapq).alias("maq"))
    return out.withColumns({"svid": F.concat_ws("", "chrom2", F.lit(":"), "start2", F.lit("_"), "chrom", F.lit(":"), "start"), "sv_type": F.lit("TRA"), "sv_len": F.lit(0).cast("long")})
