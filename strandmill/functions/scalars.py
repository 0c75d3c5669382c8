"""Scalar expressions on columns: sequences, chromosomes, sizes, identifiers, VCF INFO, rounding."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F


def reverse_complement(seq: Column) -> Column:
    """Of A, C, G, T in either case; other letters stay."""
    return F.reverse(F.translate(seq, "ACGTacgt", "TGCAtgca"))


def is_dna(seq: Column) -> Column:
    return seq.rlike("^[ACGTN]*$")


def chrom_order(chrom: Column, mito: bool = False) -> Column:
    """Number after an optional chr; X 100, Y 101, M 102 if mito; others 999."""
    bare = F.regexp_replace(chrom, "(?i)^chr", "")
    out = F.when(bare.rlike("^[0-9]{1,9}$"), bare.cast("int")).when(bare == "X", 100).when(bare == "Y", 101)
    return (out.when(bare == "M", 102) if mito else out).otherwise(999)


def signed_sizes(sv_type: Column, size: Column) -> tuple[Column, Column]:
    """Target and query size: DEL (+, -), INS and DUP (-, +), INV (+, +), TRA (0, 0)."""
    target = F.when(sv_type.isin("DEL", "INV"), size).when(sv_type.isin("INS", "DUP"), -size).otherwise(0)
    query = F.when(sv_type == "DEL", -size).when(sv_type.isin("INS", "DUP", "INV"), size).otherwise(0)
    return target, query


def svid(chrom: Column, start: Column, stop: Column, sv_type: Column, size: Column) -> Column:
    return F.concat(chrom, F.lit(":"), start.cast("string"), F.lit("-"), stop.cast("string"), F.lit("_"), sv_type, F.lit("="), size.cast("string"))


def svid_parts(value: Column) -> dict[str, Column]:
    """chrom, start, stop, sv_type and size of an id as svid() makes it, or with LEN after the type."""
    pattern = r"^(.*):(-?[0-9]+)-(-?[0-9]+)_([A-Z]+?)(?:LEN)?=(-?[0-9]+)$"
    part = lambda k: F.nullif(F.regexp_extract(value, pattern, k), F.lit(""))
    return {"chrom": part(1), "start": part(2).cast("long"), "stop": part(3).cast("long"), "sv_type": part(4), "size": part(5).cast("long")}


def info_map(info: Column) -> Column:
    """Key to value of a VCF INFO text; a flag has a null value."""
    return F.str_to_map(info, F.lit(";"), F.lit("="))


def info_set(info: Column, key: str, value: Column) -> Column:
    """INFO with one key's value replaced in place, or appended."""
    parts = F.split(info, ";")
    named = F.concat(F.lit(key + "="), value.cast("string"))
    there = F.exists(parts, lambda p: F.split_part(p, F.lit("="), F.lit(1)) == key)
    changed = F.transform(parts, lambda p: F.when(F.split_part(p, F.lit("="), F.lit(1)) == key, named).otherwise(p))
    return F.array_join(F.when(there, changed).otherwise(F.array_append(parts, named)), ";")


def end_position(end: Column) -> Column:
    """END as a number; chr:pos of translocations gives pos."""
    return F.element_at(F.split(end, ":"), -1).cast("long")


def occurrences(seq: Column, site: Column) -> Column:
    """Non-overlapping occurrences."""
    return ((F.length(seq) - F.length(F.replace(seq, site, F.lit("")))) / F.length(site)).cast("int")


def split_lengths(seq: Column, site: str) -> Column:
    return F.transform(F.split(seq, site), lambda p: F.length(p))


def substitute(seq: Column, at: Column, base: Column) -> Column:
    """seq with the base at 1-based place at replaced."""
    return F.overlay(seq, base, at)


def round_half_even(x: Column, digits: int) -> Column:
    """x rounded by its binary value, ties to even: 0.0625 to 3 digits is 0.062, and 2.675, which lies below its decimal
    text, is 2.67 to 2. The product with 2 * 10**digits is compared with the odd number next to it; where it equals that after rounding, the part that
    rounding lost decides, from the two halves of x."""
    size = F.abs(x.cast("double"))
    down = F.floor(size * float(10**digits)).cast("double")
    middle = 2.0 * down + 1.0
    high = size * 134217729.0 - (size * 134217729.0 - size)
    scale = 2.0 * 10**digits
    lost = (high * scale - middle) + (size - high) * scale
    above = size * scale - middle
    part = F.when(above != 0, above).otherwise(lost)
    whole = F.when(part > 0, down + 1).when(part < 0, down).otherwise(down + down % 2)
    return F.signum(x.cast("double")) * whole / float(10**digits)


def interior_points(start: Column, stop: Column, n: int = 6) -> Column:
    """n places that divide start to stop into n + 1 parts, rounded down."""
    return F.transform(F.sequence(F.lit(1), F.lit(n)), lambda i: F.floor(start + i * (stop - start) / (n + 1)).cast("long"))


def promoter(start: Column, stop: Column, strand: Column, size: int = 3000) -> tuple[Column, Column]:
    """The size bases before a gene, by strand; not below 1."""
    low = F.when(strand == "+", start - size).otherwise(stop + 1)
    high = F.when(strand == "+", start - 1).otherwise(stop + size)
    return F.greatest(low, F.lit(1)), high


def one_hot_gt(gt: Column) -> Column:
    """[0/0, 0/1, 1/1, missing] as 0 or 1; phase is ignored."""
    flat = F.translate(gt, "|", "/")
    hit = lambda *v: F.when(flat.isin(*v), 1).otherwise(0)
    return F.array(hit("0/0"), hit("0/1", "1/0"), hit("1/1"), F.when(flat.isNull() | flat.contains("."), 1).otherwise(0))


#: Piecewise tolerances by length; fixed values: per row upper length, constant, slope, length subtracted, whether rounded up.
TOLERANCES = {
    "high": [(100, 50, 0.8, 50, True), (500, 100, 0.8, 100, True), (5000, 450, 0.1, 500, True), (None, 1000, 0, 0, False)],
    "high_ins": [(100, 40, 0.8, 50, False), (500, 80, 0.8, 100, False), (5000, 400, 0.1, 500, False), (None, 1000, 0, 0, False)],
    "low": [(100, 25, 0.8, 50, True), (500, 50, 0.8, 100, True), (5000, 100, 0.1, 500, True), (None, 800, 0, 0, False)],
    "low_ins": [(100, 25, 0.4, 50, False), (500, 50, 0.4, 100, False), (5000, 200, 0.05, 500, False), (None, 800, 0, 0, False)],
    "fixed_ins": [(100, 50, 0.5, 50, False), (500, 100, 0.5, 100, False), (5000, 300, 0.1, 500, False), (None, 1000, 0, 0, False)],
}


def tolerance(size: Column, name: str) -> Column:
    """Allowed distance for a length."""
    out = None
    for upper, base, slope, off, up in TOLERANCES[name]:
        part = F.lit(slope) * (size - off) if slope else F.lit(0.0)
        value = F.lit(float(base)) + (F.ceil(part).cast("double") if up else part.cast("double"))
        out = F.when(size <= upper, value) if out is None else out.otherwise(value) if upper is None else out.when(size <= upper, value)
    return out


def tolerance_of(size: float, name: str) -> float:
    """The same for a number."""
    for upper, base, slope, off, up in TOLERANCES[name]:
        if upper is None or size <= upper:
            part = slope * (size - off)
            return float(base + (math.ceil(part) if up else part))
    raise ValueError(size)
