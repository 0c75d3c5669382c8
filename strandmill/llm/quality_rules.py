"""Quality rules by distribution divergence, in DataFrame functions only.

A document's histogram over character classes and its histogram over common words are compared, by
Jensen-Shannon distance (base 2, 0 to 1), to those of each language; it is kept if the nearest
language is near enough in both. The references are the sums over all documents of a language that
pass the base rules; texts under MIN_CHARS or MIN_WORDS are too short to judge and are kept if the
base rules keep them.

Defined results: a null or blank text has 0 words and fails the base rules; repeated rows are judged
each; with no labelled row there is no reference and the base rules alone decide; an empty table
gives an empty table.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandmill.llm.shared import SEPARATORS, SPACE, cut

#: Common words of the four languages; fixed values.
COMMON = {
    "en": "the of and to in is that was for it with as on be at by this are from or".split(),
    "de": "der die und in den von zu das mit sich des auf für ist im dem nicht ein eine als".split(),
    "fr": "de la le et les des en un du une que est pour qui dans par sur pas plus avec".split(),
    "es": "de la que el en y a los del se las por un para con no una su al lo".split(),
}
COMMON_WORDS = sorted({w for words in COMMON.values() for w in words})
#: Character classes as regex bodies of what is counted.
CLASSES = {"lower": r"\p{Ll}", "upper": r"\p{Lu}", "digit": r"\p{N}", "space": SPACE, "stop": r".,;:?'\"()\-", "symbol": r"!#*$%&|<>=+/\\~^@_{}\[\]`"}
MIN_CHARS, MIN_WORDS = 200, 50
MAX_CLASS_DISTANCE, MAX_WORD_DISTANCE = 0.28, 0.45
#: Each of up to so many languages has an expression of its own; more are one array that a loop goes through. None is left out.
MAX_LITERALS = 64


def words_of(text: Column) -> Column:
    trimmed = F.btrim(text, F.lit(SEPARATORS))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, rf"[{SPACE}]+"))


def window_table(words: Column) -> Column:
    """3-word windows with their places, sorted, so that equal ones are neighbours. Built and sorted without lambdas."""
    n = F.size(words)
    zipped = F.arrays_zip(words.alias("a"), F.slice(words, 2, F.greatest(n, F.lit(1))).alias("b"), F.slice(words, 3, F.greatest(n, F.lit(1))).alias("c"), F.sequence(F.lit(0), n - 1).alias("i"))
    return F.when(n >= 3, F.sort_array(F.slice(zipped, 1, n - 2)))


def equal_neighbours(windows: Column) -> Column:
    """Indices from 1 of the windows of a sorted table that equal the one before."""
    same = lambda x, y: (x["a"] == y["a"]) & (x["b"] == y["b"]) & (x["c"] == y["c"])
    found = F.filter(F.sequence(F.lit(1), F.size(windows) - 1), lambda k: same(F.get(windows, k), F.get(windows, k - 1)))
    return F.when(F.size(windows) >= 2, found).otherwise(F.array().cast("array<int>"))


def repeated_places(windows: Column, equal: Column) -> Column:
    """Places, in order, of the windows found twice or more."""
    place = lambda back: F.transform(equal, lambda k: F.get(windows, k - back)["i"])
    return F.sort_array(F.array_distinct(F.concat(place(0), place(1))))


def covered_words(places: Column) -> Column:
    """Number of words that the windows at these places cover: each adds what the one before leaves of its three."""
    fold = F.aggregate(places, F.struct(F.lit(-3).alias("at"), F.lit(0).alias("n")), lambda a, i: F.struct(i.alias("at"), (a["n"] + F.least(F.lit(3), i - a["at"])).alias("n")))
    return F.when(F.size(places) == 0, 0).otherwise(fold["n"])


def run_ends(words: Column) -> Column:
    """Numbers from 1 of the last of each run of equal words in a sorted list."""
    n = F.size(words)
    return F.when(n < 1, F.array().cast("array<int>")).otherwise(F.filter(F.sequence(F.lit(1), n), lambda k: ~F.get(words, k - 1).eqNullSafe(F.get(words, k))))


def word_counts(words: Column, ends: Column) -> Column:
    """(i, n): the place in COMMON_WORDS of each run's word and its length."""
    listed = F.array(*map(F.lit, COMMON_WORDS))
    one = lambda k, j: F.struct((F.array_position(listed, F.get(words, k - 1)) - 1).cast("int").alias("i"), (k - F.coalesce(F.get(ends, j - 1), F.lit(0))).cast("long").alias("n"))
    return F.transform(ends, one)


def features(docs: DataFrame, text_col: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Base counts, base_failed, and the two histograms (classes, commons: (i, n) of the bins with something) of each row,
    with the keep columns in a struct named row."""
    t, rest = F.col("t"), F.col("rest")
    length_of = lambda text, body: F.length(F.regexp_replace(text, rf"[^{body}]+", "")).cast("long")
    lines = F.filter(F.split("t", "\n"), lambda x: x.rlike(rf"[^{SPACE}]"))
    table = docs.select(F.struct(*keep).alias("row"), F.coalesce(F.col(text_col), F.lit("")).alias("t"))
    # lower-case letters, most of a text, are counted by what is left without them; the other classes in the rest
    table = table.withColumns({"words": words_of(t), "rest": F.regexp_replace(t, rf"[{CLASSES['lower']}]+", ""), "n_chars": F.length(t).cast("long")})
    others = list(CLASSES)[1:]
    table = table.select(
        "row", "n_chars",
        F.size("words").cast("long").alias("n_words"),
        length_of(rest, r"#*$%&|<>").alias("n_symbols"),
        lines.alias("lines"), window_table(F.col("words")).alias("windows"),
        (F.col("n_chars") - F.length("rest")).alias("lower"), *[length_of(rest, CLASSES[c]).alias(c) for c in others],
        F.sort_array(F.filter(F.split(F.lower("t"), r"[^\p{L}\p{N}]+"), lambda w: w.isin(COMMON_WORDS))).alias("found"),
    )
    table = table.withColumns({"equal": equal_neighbours(F.col("windows")), "ends": run_ends(F.col("found"))})
    places = F.when(F.size("equal") == 0, F.array().cast("array<int>")).otherwise(repeated_places(F.col("windows"), F.col("equal")))
    table = table.withColumns({"places": places, "listed": word_counts(F.col("found"), F.col("ends"))})
    left = lambda i, n: F.struct(F.lit(i).alias("i"), F.greatest(F.lit(0).cast("long"), n).alias("n"))
    classed = sum((F.col(c) for c in others), F.col("lower"))
    classes = F.filter(F.array(*[left(k, F.col(c)) for k, c in enumerate(CLASSES)], left(len(CLASSES), F.col("n_chars") - classed)), lambda x: x["n"] > 0)
    commons = F.filter(F.concat("listed", F.array(left(len(COMMON_WORDS), F.col("n_words") - F.size("found")))), lambda x: x["n"] > 0)
    return table.select(
        "row", "n_chars", "n_words", (F.col("n_chars") - F.col("space")).alias("word_chars"), "n_symbols",
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        covered_words(F.col("places")).cast("long").alias("n_repeat_words"), classes.alias("classes"), commons.alias("commons"),
    ).withColumn("base_failed", (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words")))


def distance(present: Column, q: list[float] | Column) -> Column:
    """Jensen-Shannon distance, base 2, of a histogram and the shares q, which sum to 1. present: the histogram's
    positive shares as (i, p); elsewhere a term is half of q's, so those need no visit."""
    table = q if isinstance(q, Column) else F.array(*[F.lit(float(x)) for x in q])

    def term(x: Column) -> Column:
        p, other = x["p"], F.get(table, x["i"])
        m = (p + other) / 2
        return p * F.log2(p / m) + F.when(other > 0, other * F.log2(other / m)).otherwise(0.0) - other

    total = F.aggregate(present, F.lit(0.0), lambda a, x: a + term(x))
    return F.when(F.size(present) == 0, 1.0).otherwise(F.sqrt(F.least(F.lit(1.0), F.greatest(F.lit(0.0), (1 + total) / 2))))


def shares(counts: Column) -> Column:
    """Counts (i, n) as (i, p), shares of their sum."""
    total = F.aggregate(counts, F.lit(0).cast("long"), lambda a, x: a + x["n"])
    return F.transform(counts, lambda x: F.struct(x["i"].alias("i"), F.try_divide(x["n"].cast("double"), total).alias("p")))


SIZES = {"classes": len(CLASSES) + 1, "commons": len(COMMON_WORDS) + 1}


def references(table: DataFrame, lang: Column) -> DataFrame:
    """A row per language with the shares of its classes and of its common words, from the sums over all rows that pass
    the base rules. A row adds its bins with something, so a task holds a language's bins, not its rows."""
    passed = table.where(lang.isNotNull() & ~F.col("base_failed")).select(lang.alias("lang"), "classes", "commons")
    named = lambda c: F.transform(c, lambda x: F.struct(F.lit(c).alias("c"), x["i"].alias("i"), x["n"].alias("n")))
    bins = F.concat(*map(named, SIZES))
    sums = passed.select("lang", F.explode_outer(bins).alias("b")).groupBy("lang", "b.c", "b.i").agg(F.sum("b.n").alias("n"))
    share = {}
    for c, size in SIZES.items():
        total = F.sum(F.when(F.col("c") == c, F.col("n")))
        share[c] = F.array(*[F.coalesce(F.try_divide(F.sum(F.when((F.col("c") == c) & (F.col("i") == k), F.col("n"))).cast("double"), total), F.lit(0.0)) for k in range(size)])
    return sums.groupBy("lang").agg(*[v.alias(c) for c, v in share.items()])


def judge(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", keep: tuple[str, ...] = ("doc_id",), max_class: float = MAX_CLASS_DISTANCE, max_word: float = MAX_WORD_DISTANCE) -> DataFrame:
    """The keep columns, base counts, class_distance and word_distance to the nearest language, kept."""
    both = tuple(dict.fromkeys((*keep, lang_col)))
    table = cut(features(docs, text_col, both))
    known = sorted(references(table, F.col(f"row.{lang_col}")).collect(), key=lambda r: str(r["lang"]))  # a row of each language
    out = table.withColumns({"p": shares(F.col("classes")), "q": shares(F.col("commons"))})
    if not known:
        nearest = lambda own, c: F.lit(0.0)
    elif len(known) > MAX_LITERALS:
        nearest = lambda own, c: F.least(F.array_min(F.transform(F.array(*[F.lit(np.array(r[c])) for r in known]), lambda q: distance(F.col(own), q))), F.lit(1.0))
    else:
        nearest = lambda own, c: F.least(*[distance(F.col(own), r[c]) for r in known], F.lit(1.0))
    out = out.withColumns({"class_distance": nearest("p", "classes"), "word_distance": nearest("q", "commons")})
    short = (F.col("n_chars") < MIN_CHARS) | (F.col("n_words") < MIN_WORDS)
    near = (F.col("class_distance") <= max_class) & (F.col("word_distance") <= max_word)
    out = out.withColumn("kept", ~F.col("base_failed") & (short | near))
    return out.select(*[F.col(f"row.{c}").alias(c) for c in keep], "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "class_distance", "word_distance", "kept")
