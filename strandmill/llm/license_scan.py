"""Licence scan: ordered signature rules behind a keyword prefilter, in DataFrame functions only.

One pass finds which rules' keywords a text has; only rules of those keywords are matched. All
detections of a text, with their places, are ordered by start, longest first, then priority; one is
dropped if it lies within another of the same or a better priority. Nothing is shuffled, and a
text's detections are resolved in one fold that keeps one end per priority, not in pairs.

Base phrases are found beside the rules, on words: runs of ASCII letters and digits and of all
characters from U+0080 on.

Defined results: a null text is empty, with no words, phrases or labels; texts of any length are
scanned whole; repeated rows are scanned each; an empty table gives an empty table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandmill.llm.license_rules import WEIGHTS, Rule, rules

#: Regex class bodies: word characters in either case of ASCII letters, and the others.
WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]"
BREAK = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]"
#: Base phrases and labels; fixed values.
PHRASES = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}
BASE = rf"(?i)(?<!{WORD})(?:{'|'.join(p.replace(' ', BREAK + '+') for p in PHRASES)})(?!{WORD})"


def count_words(text: Column) -> Column:
    return F.size(F.regexp_extract_all(text, F.lit(f"{WORD}+"), F.lit(0))).cast("long")


def keyword_pattern(known: list[Rule]) -> str:
    """Finds the rules' keywords as whole words; alternatives share their first letter, so that most places fail on one."""
    by_first: dict[str, list[str]] = {}
    for word in sorted({r.keyword for r in known} | {p.split(" ")[0] for p in PHRASES}):
        by_first.setdefault(word[0], []).append(word[1:])
    heads = "|".join(f"{c}(?:{'|'.join(sorted(tails, key=lambda t: (-len(t), t)))})" for c, tails in by_first.items())
    return rf"(?i)(?<![A-Za-z0-9])(?:{heads})(?![A-Za-z0-9])"


def detections(text: Column, keywords: Column, known: list[Rule]) -> Column:
    """Array of (start, -end, priority, label), in order, of the rules whose keyword is among keywords."""
    table = F.array(*[F.struct(F.lit(r.keyword).alias("k"), F.lit(r.priority).alias("p"), F.lit(r.label).alias("l"), F.lit(r.pattern).alias("x")) for r in known])

    def spans(r: Column) -> Column:
        hits = F.regexp_extract_all(text, r["x"], F.lit(0))
        gaps = F.split(text, r["x"], -1)
        start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,stop:int,p:int,l:string>>").alias("out"))

        def step(a: Column, i: Column) -> Column:
            begin = a["at"] + F.length(F.get(gaps, i))
            end = begin + F.length(F.get(hits, i))
            return F.struct(end.alias("at"), F.array_append(a["out"], F.struct(begin.alias("start"), (-end).alias("stop"), r["p"].alias("p"), r["l"].alias("l"))).alias("out"))

        return F.when(F.size(hits) > 0, F.aggregate(F.sequence(F.lit(0), F.size(hits) - 1), start, step, lambda a: a["out"])).otherwise(start["out"])

    fitting = F.filter(table, lambda r: F.array_contains(keywords, r["k"]))
    return F.array_sort(F.flatten(F.transform(fitting, spans)))


def resolve(found: Column) -> Column:
    """Labels (sorted, distinct), best weight and number of the detections that lie within no other of their priority or better."""
    levels = sorted(WEIGHTS)
    weight = lambda p: F.element_at(F.array(*[F.lit(WEIGHTS[k]) for k in levels]), p)
    start = F.struct(F.transform(F.array(*map(F.lit, levels)), lambda x: F.lit(-1)).alias("ends"), F.array().cast("array<string>").alias("labels"), F.lit(0.0).alias("score"), F.lit(0).alias("n"))

    def step(a: Column, d: Column) -> Column:
        end = -d["stop"]
        within = F.exists(F.slice(a["ends"], 1, d["p"]), lambda e: e >= end)
        ends = F.transform(a["ends"], lambda e, i: F.when((i + 1 == d["p"]) & (e < end), end).otherwise(e))
        return F.when(within, a).otherwise(
            F.struct(ends.alias("ends"), F.array_union(a["labels"], F.array(d["l"])).alias("labels"), F.greatest(a["score"], weight(d["p"])).alias("score"), (a["n"] + 1).alias("n"))
        )

    return F.aggregate(found, start, step, lambda a: F.struct(F.array_sort(a["labels"]).alias("labels"), a["score"].alias("score"), a["n"].alias("n")))


def scan(docs: DataFrame, text_col: str = "text", keep: tuple[str, ...] = ("doc_id",), known: list[Rule] | None = None) -> DataFrame:
    """The keep columns, n_words, base places, first and last word, base_labels, labels, score and n_detections."""
    known = rules() if known is None else known
    none = F.array().cast("array<string>")
    rows = docs.select(*keep, F.coalesce(F.col(text_col), F.lit("")).alias("t"))
    rows = rows.withColumn("keywords", F.array_distinct(F.transform(F.regexp_extract_all("t", F.lit(keyword_pattern(known)), F.lit(0)), lambda w: F.lower(w))))
    some = F.size("keywords") > 0
    rows = rows.withColumns({
        "n_words": count_words(F.col("t")),
        "hits": F.when(some, F.regexp_extract_all("t", F.lit(BASE), F.lit(0))).otherwise(none),
        "method": F.when(some, resolve(detections(F.col("t"), F.col("keywords"), known))),
    })
    rows = rows.withColumn("gaps", F.when(F.size("hits") > 0, F.split("t", BASE, -1)))
    label = lambda hit: F.coalesce(*[F.when(F.lower(F.substring(hit, 1, len(p.split(" ")[0]))) == p.split(" ")[0], F.lit(v)) for p, v in PHRASES.items()])
    found = F.size("hits") > 0
    last_gap, last_hit = F.element_at("gaps", -1), F.element_at("hits", -1)
    return rows.withColumn("base", F.array_sort(F.array_distinct(F.transform("hits", label)))).select(
        *keep, "n_words", F.size("hits").cast("long").alias("n_base"),
        F.when(found, count_words(F.get("gaps", F.lit(0)))).alias("first_word"),
        F.when(found, F.col("n_words") - count_words(last_gap) - count_words(last_hit)).alias("last_word"),
        F.array_join("base", ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union("base", F.coalesce(F.col("method.labels"), none))), ",").alias("labels"),
        F.coalesce(F.col("method.score"), F.lit(0.0)).alias("score"),
        F.coalesce(F.col("method.n"), F.lit(0)).alias("n_detections"),
    )
