"""Markers: SNPs from pileups, restriction sites, primers."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandmill.functions.scalars import is_dna, round_half_even
from strandmill.operators.runs import map_runs
from strandmill.operators.sequences import chunked, slices

BASES = ("A", "C", "G", "T")

#: Published nearest-neighbour enthalpies (kcal/mol) and entropies (cal/(mol K)) of DNA pairs, unified set; fixed values.
STACKS = {
    "AA": (-7.9, -22.2), "AT": (-7.2, -20.4), "TA": (-7.2, -21.3), "CA": (-8.5, -22.7), "GT": (-8.4, -22.4),
    "CT": (-7.8, -21.0), "GA": (-8.2, -22.2), "CG": (-10.6, -27.2), "GC": (-9.8, -24.4), "GG": (-8.0, -19.9),
}


def pileup_snps(pileup: DataFrame, top: float = 0.95, by_samples: bool = True) -> DataFrame:
    """pileup: chrom, pos, columns (the text columns from the fourth on, three a sample: depth, bases, qualities). Once read
    starts (^ and the character after it) and ends ($) are gone, letters A, C, G, T in either case are counted over all
    columns. Frequencies divide by the number of samples, to three places; by_samples=False divides by the four counts'
    sum. Sites whose commonest base is under top and that have a second one, or as many of it. Of equal counts the
    order is A, T, C, G."""
    text = F.upper(F.regexp_replace(F.array_join("columns", ","), r"\^.|\$", ""))
    counts = pileup.withColumn("b", text).withColumn("n", F.array(*[F.struct((F.length("b") - F.length(F.translate("b", x, ""))).cast("long").alias("n"), F.lit(-k).alias("k"), F.lit(x).alias("base")) for k, x in enumerate(("A", "T", "C", "G"))]))
    ranked = counts.withColumn("n", F.reverse(F.array_sort("n")))
    total = F.floor(F.size("columns") / 3).cast("long") if by_samples else F.aggregate("n", F.lit(0).cast("long"), lambda a, x: a + x["n"])
    first, second = F.get("n", F.lit(0)), F.get("n", F.lit(1))
    out = ranked.select("chrom", "pos", first["base"].alias("con"), second["base"].alias("mut"), first["n"].alias("con_n"), second["n"].alias("mut_n"), total.alias("total"))
    freq = lambda c: round_half_even(F.col(c) / F.col("total"), 3)
    out = out.where("total > 0").withColumns({"con_freq": freq("con_n"), "mut_freq": freq("mut_n")})
    return out.where((F.col("con_freq") < top) & (F.col("mut_n") > 0)).drop("total")


def _parts(text: Column, width: int) -> Column:
    """The parts of width letters of the 11 bases around a SNP."""
    return F.transform(F.sequence(F.lit(1), F.lit(12 - width)), lambda k: F.substring(text, k, F.lit(width)))


def caps_sites(snps: DataFrame, sequences: DataFrame, enzymes: DataFrame, length: int = 500) -> DataFrame:
    """Sites of an enzyme that one allele alone has within the 11 bases around the SNP, on tiles of length bases
    that begin length - 50, ... 50 bases before it, in steps of 50, and that hold the site twice at most.
    enzymes: name, site; sequences: chunks (chrom, chunk, text) or chrom, seq; snps: each chrom, pos, con, mut once. A site of no or over 11 letters is in none."""
    store = sequences if "chunk" in sequences.columns else chunked(sequences)
    # one slice around a SNP holds all its tiles and the 11 bases
    low = F.greatest(F.least(F.col("pos") - (length - 50), F.col("pos") - 6), F.lit(0))
    asked = snps.withColumns({"start": low, "stop": F.col("pos") + F.lit(max(length - 50, 6))})
    at = slices(store, asked, snps.columns, name="context").where("context is not null")
    around = F.expr("substring(context, cast(pos - 5 - start as int), 11)")
    pair = F.array(*[F.struct(F.lit(kind).alias("allele"), F.col(kind).alias("base"), F.col(f"{kind}_freq").alias("freq"), F.overlay(around, F.col(kind), F.lit(6), F.lit(1)).alias("own"), F.overlay(around, F.col(other), F.lit(6), F.lit(1)).alias("other")) for kind, other in (("con", "mut"), ("mut", "con"))])
    alleles = at.where("pos > 5").withColumn("a", F.explode(pair))
    sites = enzymes.select("name", "site").withColumn("size", F.length("site"))
    widths = [r["size"] for r in sites.select("size").distinct().where("size between 1 and 11").collect()]
    # every part of the 11 bases that is as long as some site is a key, so an enzyme meets only the alleles that have its site
    own = F.array_distinct(F.flatten(F.array(*[_parts(F.col("a.own"), w) for w in widths or [1]])))
    hits = alleles.withColumn("site", F.explode(own)).join(sites.drop("size"), "site").where(~F.col("a.other").contains(F.col("site")))
    tiles = hits.withColumn("before", F.explode(F.sequence(F.lit(length - 50), F.lit(50), F.lit(-50)))).where("pos - before >= 0")
    tile = F.overlay(F.expr(f"substring(context, cast(pos - before - start as int) + 1, {length})"), F.col("a.base"), F.col("before"))
    named = tiles.withColumn("tile", tile)
    count = ((F.length("tile") - F.length(F.replace("tile", F.col("site"), F.lit("")))) / F.length("site")).cast("int")
    parts = F.array_join(F.transform(F.split("tile", F.col("site")), lambda p: F.length(p).cast("string")), ".")
    return named.withColumn("sites", count).where("sites <= 2").select("chrom", "pos", F.col("a.allele").alias("allele"), F.col("a.freq").alias("freq"), F.col("name").alias("enzyme"), "before", "sites", F.when(F.col("sites") == 2, parts).alias("lengths"), "tile")


#: Molar salt and primer of the estimates; pairs of primers worked out at once.
SALT, DNA = 0.05, 50e-9
TOGETHER = 512
#: Primers that a worker holds before they leave it, and those of one template more.
PRIMERS = 10_000


def melting_temperature(seq: str, salt: float = SALT, dna: float = DNA) -> float:
    """Nearest-neighbour estimate, in degrees Celsius."""
    flip = str.maketrans("ACGT", "TGCA")
    heat, order = 0.2, -5.7
    for a, b in zip(seq, seq[1:]):
        pair = STACKS.get(a + b) or STACKS.get((a + b).translate(flip)[::-1])
        if pair is None:
            return math.nan
        heat, order = heat + pair[0], order + pair[1]
    for end in (seq[0], seq[-1]):
        if end in "AT":
            heat, order = heat + 2.2, order + 6.9
    order += 0.368 * (len(seq) - 1) * math.log(salt)
    return 1000 * heat / (order + 1.987 * math.log(dna / 4)) - 273.15


#: Published free energies (kcal/mol at 37 degrees) of loops by their unpaired bases, bulges from one and internal loops from three, and
#: an estimate for one base against one, whose mean is near this; fixed values.
BULGES = (4.0, 2.9, 3.2, 3.3)
INTERNAL = (3.2, 3.6, 4.0, 4.4, 4.6, 4.8)
MISMATCH = 0.8
WARM = 310.15


def _loops() -> list[tuple[int, int, float]]:
    """Unpaired bases on either strand and the loop's entropy, cal/(mol K)."""
    out = []
    for i in range(5):
        for j in range(5):
            if i + j and (i == 0 or j == 0):
                out.append((i, j, BULGES[i + j - 1]))
            elif i and j:
                out.append((i, j, MISMATCH if i + j == 2 else INTERNAL[i + j - 3]))
    return [(i, j, -1000 * energy / WARM) for i, j, energy in out]


def duplexes(first: list[str], second: list[str], salt: float = SALT, dna: float = DNA) -> tuple[np.ndarray, np.ndarray]:
    """Of each pair of primers the melting estimate (degrees Celsius; -273.15 if they have no pair) and the free energy at 37 degrees
    (kcal/mol) of their most stable duplex: runs of stacked pairs, parted by bulges, mismatches and internal loops of
    up to four bases on a strand, with the ends' penalties. A dynamic programme over both strands, all pairs at once."""
    n, flip = len(first), str.maketrans("ACGT", "TGCA")
    size = [max(map(len, x), default=0) for x in (first, second)]
    code = {c: k for k, c in enumerate(BASES)}
    a, b = (np.full((n, w), pad, np.int64) for w, pad in zip(size, (9, 6)))
    for k, (x, y) in enumerate(zip(first, second)):
        a[k, : len(x)] = [code.get(c, 8) for c in x]
        b[k, : len(y)] = [code.get(c, 7) for c in y.translate(flip)[::-1]]  # paired where equal
    stack = np.full((10, 10, 2), np.nan)
    for i, x in enumerate(BASES):
        for j, y in enumerate(BASES):
            stack[i, j] = STACKS.get(x + y) or STACKS[(x + y).translate(flip)[::-1]]
    paired = a[:, :, None] == b[:, None, :]
    weak = np.isin(a, (0, 3))
    # of the best duplex that ends in the pair (i, j): free energy at 37 degrees, heat, order
    energy = np.full((n, *size), np.inf)
    heat, order = np.zeros((n, *size)), np.zeros((n, *size))
    steps = [(0, 0, 0.0), *_loops()]
    rows = np.arange(n)
    end = (np.full(n, np.inf), np.zeros(n), np.zeros(n))
    for i in range(size[0]):
        # all places of the second strand at once: a pair follows pairs of earlier places of the first
        ends = np.where(weak[:, i], 1.0, 0.0)
        h0, s0 = 0.2 + 2.2 * ends, -5.7 + 6.9 * ends
        best = [np.repeat(v[:, None], size[1], 1) for v in (h0 - WARM * s0 / 1000, h0, s0)]
        for p, q, loop in steps:
            x = i - 1 - p
            if x < 0 or q + 1 >= size[1]:
                continue
            if p == q == 0 or p + q == 1:  # a single bulged base leaves the stack
                pair = stack[a[:, x], a[:, i]]
                dh, ds = pair[:, :1], pair[:, 1:] + 0.368 * math.log(salt) + loop
            else:
                dh, ds = 0.0, loop
            old = slice(0, size[1] - 1 - q)
            e = energy[:, x, old] + (dh - WARM * ds / 1000)
            better = e < best[0][:, 1 + q :]
            for own, new in zip(best, (e, heat[:, x, old] + dh, order[:, x, old] + ds)):
                own[:, 1 + q :] = np.where(better, new, own[:, 1 + q :])
        energy[:, i] = np.where(paired[:, i], best[0], np.inf)
        heat[:, i], order[:, i] = best[1], best[2]
        shut = np.where(weak[:, i], 2.2 - WARM * 6.9 / 1000, 0.0)
        j = energy[:, i].argmin(1)
        whole = energy[rows, i, j] + shut
        better = whole < end[0]
        end = tuple(np.where(better, new, old) for new, old in zip((whole, heat[rows, i, j] + 2.2 * ends, order[rows, i, j] + 6.9 * ends), end))
    found = np.isfinite(end[0])
    with np.errstate(divide="ignore", invalid="ignore"):
        warm = np.where(found, 1000 * end[1] / (end[2] + 1.987 * math.log(dna / 4)) - 273.15, -273.15)
    return np.maximum(warm, -273.15), np.where(found, end[0], 0.0)


def pairing_temperature(a: str, b: str) -> float:
    """duplexes() of one pair."""
    return float(duplexes([a], [b])[0][0])


def _windows(seq: str, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each place at which a window of size letters begins: whether it is all A, C, G, T, its GC share and its melting estimate,
    from running sums over the sequence."""
    letters = np.frombuffer(seq.encode("ascii", "replace"), np.uint8)
    base = np.full(256, 4, np.int64)
    base[[ord(c) for c in BASES]] = range(4)
    code = base[letters]
    flip = str.maketrans("ACGT", "TGCA")
    stacks = np.zeros((5, 5, 2))
    for i, x in enumerate(BASES):
        for j, y in enumerate(BASES):
            stacks[i, j] = STACKS.get(x + y) or STACKS[(x + y).translate(flip)[::-1]]
    total = lambda v: np.concatenate([[0], np.cumsum(v)])
    over = lambda v, n: v[n:] - v[:-n]
    clean = over(total(code == 4), size) == 0
    gc = 100.0 * over(total((code == 1) | (code == 2)), size) / size
    pairs = stacks[code[:-1], code[1:]]
    ends = np.isin(code, (0, 3)).astype(float)
    weak = ends[: len(code) - size + 1] + ends[size - 1 :]
    heat, order = (over(total(pairs[:, k]), size - 1) for k in (0, 1))
    heat, order = 0.2 + heat + 2.2 * weak, -5.7 + order + 6.9 * weak + 0.368 * (size - 1) * math.log(SALT)
    return clean, gc, 1000 * heat / (order + 1.987 * math.log(DNA / 4)) - 273.15


def primer_candidates(templates: DataFrame, sizes: tuple[int, int] = (18, 25), tm: tuple[float, float] = (57.0, 63.0), gc: tuple[float, float] = (40.0, 60.0), flank: int = 200) -> DataFrame:
    """templates: id, seq, sv_size. All primers of both directions in the first and last flank bases, of sizes[0] to less than sizes[1]
    letters: id, side, pos (from 0 on the template: the first base of forward, the last of reverse ones), primer, tm, gc.
    A null or short sequence has none."""
    flip = str.maketrans("ACGT", "TGCA")

    columns = ["id", "side", "pos", "primer", "tm", "gc"]

    def found(ident: str, side: str, part: str, low: int) -> Iterator[tuple]:
        for size in range(max(2, sizes[0]), min(sizes[1], len(part) + 1)):
            clean, share, heat = _windows(part, size)
            for k in np.flatnonzero(clean & (share >= gc[0]) & (share <= gc[1]) & (heat >= tm[0]) & (heat <= tm[1])).tolist():
                piece, at = part[k : k + size], low + k
                own, place = (piece, at) if side == "forward" else (piece.translate(flip)[::-1], at + size - 1)
                yield ident, side, place, own, float(heat[k]), float(share[k])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        # a template may have a thousand primers, so they leave every PRIMERS rows and not once a batch of templates
        for batch in batches:
            rows: list[tuple] = []
            for ident, head, tail, low in zip(batch["id"], batch["head"], batch["tail"], batch["low"]):
                rows.extend(found(ident, "forward", head, 0))
                rows.extend(found(ident, "reverse", tail, int(low)))
                if len(rows) >= PRIMERS:
                    yield pd.DataFrame(rows, columns=columns)
                    rows = []
            yield pd.DataFrame(rows, columns=columns)

    seq = F.coalesce("seq", F.lit(""))
    low = F.greatest(F.length(seq) - flank, F.lit(0))
    ends = templates.select("id", F.substring(seq, 1, flank).alias("head"), F.substring(seq, low + 1, F.lit(flank)).alias("tail"), low.alias("low"))
    return ends.mapInPandas(run, "id string, side string, pos long, primer string, tm double, gc double")


def pairable(templates: DataFrame, flank: int, size: int = 18, product: tuple[int, int] = (100, 1500)) -> DataFrame:
    """templates without those of which no pair of primers of size letters at least in the flanks has a product within bounds."""
    n = F.length("seq")
    nearest = F.greatest(n - flank, F.lit(0)) - F.least(n, F.lit(flank)) + 2 * size
    return templates.where((nearest <= product[1]) & (n >= product[0]) & (n - F.col("sv_size") >= product[0]))


#: Templates whose pairs are worked out together.
TEMPLATES = 64


def best_primers(candidates: DataFrame, sizes: DataFrame, product: tuple[int, int] = (100, 1500), least_difference: int = 50) -> DataFrame:
    """The best-scored pair of each template (sizes: id, sv_size): product sizes of both alleles within bounds,
    score 100 less penalties for pairing above 45 degrees, melting points more than 3 apart and GC outside 40 to 60;
    of equal ones the first by places and letters. All pairs compete, TOGETHER at a time, best bound first; once no
    bound reaches the best score, the rest are passed over. A template's candidates are bounded by its flanks."""
    gone = lambda gc: np.where(gc < 40, (40 - gc) * 0.5, np.where(gc > 60, (gc - 60) * 0.5, 0.0))
    names = ["pos", "primer", "tm", "gc"]

    def pairs(group: pd.DataFrame) -> dict:
        front, back = (group[group["side"] == k].reset_index(drop=True) for k in ("forward", "reverse"))
        differ = int(group["sv_size"].iloc[0])
        ref = back["pos"].to_numpy()[None, :] - front["pos"].to_numpy()[:, None] + 1
        fits = (ref > 1) & (ref >= product[0]) & (ref <= product[1]) & (ref - differ >= product[0]) & (ref - differ <= product[1])
        bound = 100 - np.maximum(0, np.abs(back["tm"].to_numpy()[None, :] - front["tm"].to_numpy()[:, None]) - 3) * 5 - gone(back["gc"].to_numpy())[None, :] - gone(front["gc"].to_numpy())[:, None]
        # pairs by what they could reach without pairing, the first by places and letters of equal ones, a block at a time
        open_ = np.flatnonzero(fits.ravel())
        open_ = open_[np.argsort(-bound.ravel()[open_], kind="stable")]
        return {"front": front, "back": back, "differ": differ, "ref": ref, "bound": bound.ravel(), "open": open_, "low": 0, "many": 32, "score": -math.inf, "place": -1, "found": None}

    def block(own: dict) -> np.ndarray:
        """The template's next pairs, none once no bound reaches its best score."""
        out = own["open"][own["low"] : own["low"] + own["many"]]
        own["low"], own["many"] = own["low"] + own["many"], min(2 * own["many"], TOGETHER)
        if len(out):
            first = own["bound"][out[0]]
            if first < own["score"] or first == own["score"] and own["place"] < out[0]:  # equal bounds stand by place
                return out[:0]
        return out

    def weigh(own: dict, taken: np.ndarray, heats: np.ndarray, energies: np.ndarray) -> None:
        score = own["bound"][taken] - np.maximum(0.0, heats - 45) * 2
        k = min(range(len(taken)), key=lambda x: (-score[x], taken[x]))
        if score[k] > own["score"] or score[k] == own["score"] and taken[k] < own["place"]:
            own["score"], own["place"] = float(score[k]), int(taken[k])
            i, j = divmod(int(taken[k]), len(own["back"]))
            f, r = own["front"].iloc[i], own["back"].iloc[j]
            size = int(own["ref"][i, j])
            own["found"] = (f["id"], *[f[n] for n in names], *[r[n] for n in names], own["differ"], size, size - own["differ"], float(heats[k]), float(energies[k]), own["score"])

    def together(state: list[dict]) -> None:
        """Blocks of several templates are paired in one call, whose cost hangs little on their number."""
        while state:
            asked = [(own, taken) for own in state if len(taken := block(own))]
            state = [own for own, _ in asked]
            while asked:
                n = max(1, int(np.searchsorted(np.cumsum([len(t) for _, t in asked]), TOGETHER, "right")))
                part, asked = asked[:n], asked[n:]
                forward, reverse = [], []
                for own, taken in part:
                    i, j = np.divmod(taken, len(own["back"]))
                    forward += own["front"]["primer"].to_numpy()[i].tolist()
                    reverse += own["back"]["primer"].to_numpy()[j].tolist()
                heats, energies = duplexes(forward, reverse)
                ends = np.cumsum([len(t) for _, t in part])
                for (own, taken), high in zip(part, ends):
                    weigh(own, taken, heats[high - len(taken) : high], energies[high - len(taken) : high])

    def best(rows: pd.DataFrame) -> pd.DataFrame:
        found: list[tuple] = []
        groups = [g for _, g in rows.groupby("__run", sort=True)]
        for k in range(0, len(groups), TEMPLATES):
            state = [pairs(g) for g in groups[k : k + TEMPLATES]]
            together(state)
            found += [own["found"] for own in state if own["found"]]
        return pd.DataFrame(found, columns=columns)

    kinds = {"pos": "long", "primer": "string", "tm": "double", "gc": "double"}
    made = [("id", "string"), *[(p + n, kinds[n]) for p in ("f_", "r_") for n in names], ("sv_size", "long"), ("ref_size", "long"), ("alt_size", "long"), ("pair_tm", "double"), ("pair_dg", "double"), ("score", "double")]
    columns = [n for n, _ in made]
    rows = candidates.join(sizes.where(F.abs("sv_size") >= least_difference).select("id", "sv_size"), "id")
    return map_runs(rows, ["id"], ["pos", "primer"], best, ", ".join(f"{n} {t}" for n, t in made))


def outermost_primers(candidates: DataFrame, sizes: DataFrame) -> DataFrame:
    """The last forward and the first reverse primer of each template, the tightest pair, with both alleles' products."""
    tight = candidates.groupBy("id").agg(
        F.max(F.when(F.col("side") == "forward", F.struct("pos", "primer"))).alias("f"), F.min(F.when(F.col("side") == "reverse", F.struct("pos", "primer"))).alias("r"),
    )
    out = tight.where("f is not null and r is not null and r.pos > f.pos").join(sizes.select("id", "sv_size"), "id")
    return out.select("id", F.col("f.primer").alias("forward"), F.col("r.primer").alias("reverse"), (F.col("r.pos") - F.col("f.pos") + 1).alias("ref_size"), (F.col("r.pos") - F.col("f.pos") + 1 - F.col("sv_size")).alias("alt_size"))


def best_ranked_primers(candidates: DataFrame, sizes: DataFrame, size: int = 21, tm: float = 60.0) -> DataFrame:
    """The best-ranked forward and the best-ranked reverse primer of each template, each on its own: the one nearest to size and melting
    point, the distances added, of equal ones the first by place and letters; with both alleles' products."""
    cost = F.abs(F.length("primer") - size) + F.abs(F.col("tm") - tm)
    first = lambda side: F.min(F.when(F.col("side") == side, F.struct(cost.alias("cost"), "pos", "primer")))
    ranked = candidates.groupBy("id").agg(first("forward").alias("f"), first("reverse").alias("r"))
    out = ranked.where("f is not null and r is not null and r.pos > f.pos").join(sizes.select("id", "sv_size"), "id")
    return out.select("id", F.col("f.primer").alias("forward"), F.col("f.pos").alias("f_pos"), F.col("r.primer").alias("reverse"), F.col("r.pos").alias("r_pos"), (F.col("r.pos") - F.col("f.pos") + 1).alias("ref_size"), (F.col("r.pos") - F.col("f.pos") + 1 - F.col("sv_size")).alias("alt_size"))


def genotype_templates(rows: DataFrame, sequences: DataFrame, flank: int = 600) -> DataFrame:
    """Sequence of flank bases on both sides of the rows of a genotype table (id, chrom, start, stop, sv_size; places count from 0), in capitals:
    seqid and seq. Rows that begin under flank - 20 and sequences with other letters than A, C, G, T and N go."""
    store = sequences if "chunk" in sequences.columns else chunked(sequences)
    asked = rows.where(F.col("start") + 20 >= flank).select("id", "chrom", F.greatest(F.col("start") - flank, F.lit(0)).alias("start"), (F.col("stop") + flank).alias("stop"), "sv_size")
    named = asked.withColumn("seqid", F.concat("chrom", F.lit(":"), F.col("start").cast("string"), F.lit("-"), F.col("stop").cast("string")))
    found = slices(store, named, ["id"], name="seq").withColumn("seq", F.upper("seq"))
    return found.where(is_dna(F.col("seq")) & (F.length("seq") > 0)).select("id", "seqid", "seq", "sv_size")


def templates(sites: DataFrame, sequences: DataFrame, flank: int = 600) -> DataFrame:
    """Sequence around each site (id, chrom, start, stop, sv_size), flank bases on both sides, within bounds and without N."""
    store = sequences if "chunk" in sequences.columns else chunked(sequences)
    asked = sites.where(F.col("start") - flank > 0).withColumns({"__start": F.col("start"), "__stop": F.col("stop"), "start": F.col("start") - flank - 1, "stop": F.col("stop") + flank})
    cut = slices(store, asked, asked.columns, name="seq").where((F.length("seq") == F.col("stop") - F.col("start")) & ~F.col("seq").contains("N"))
    return cut.withColumns({"start": F.col("__start"), "stop": F.col("__stop")}).drop("__start", "__stop")
