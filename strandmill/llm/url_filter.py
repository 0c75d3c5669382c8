"""URL filter: a sorted array of 64-bit digests, mapped into memory and probed by binary search.

Rules are (host, path, verdict). A rule fits its host and all subdomains if the url's path starts
with the rule's path; the longest rule string wins. For each url the possible rule strings are a
label suffix of its host and a prefix of its path of a length that some rule has; their xxhash64
digests are looked up in the sorted array in one vectorised search, and a hit counts only if the
stored full string is the candidate itself, so digest collisions do no harm.

Defined results: a null url, or one without "://", has empty host and path and fits no rule; equal
rule strings with different verdicts block; repeated rows are judged each; an empty table gives an
empty table; input columns are kept unless named like a result column, which replaces them.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import SparkFiles
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from strandmill.llm.shared import ship_bytes

#: Largest packed rule list that is copied to the executors; larger lists are joined on digests.
SHIP_LIMIT_BYTES = 256 << 20
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def url_host(url: Column) -> Column:
    """After the first :// up to /, ?, # or end, A-Z lower-cased; else empty."""
    return F.coalesce(F.translate(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), UPPER, LOWER), F.lit(""))


def url_path(url: Column) -> Column:
    """After the host up to ?, # or end; else empty."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def pack_rules(rules: Iterable[tuple[str, str, str]]) -> bytes:
    """Sections, each after its length in bytes: digests, string offsets, verdicts (1: block), path lengths, strings."""
    verdicts: dict[str, int] = {}
    lengths = set()
    for host, path, verdict in rules:
        if host is None or not host:
            continue
        path = path or ""
        verdicts[host + path] = max(verdicts.get(host + path, 0), int(verdict == "block"))
        lengths.add(len(path))
    keyed = sorted((xxhash.xxh64_intdigest(key.encode()), key) for key in verdicts)
    strings = [key.encode() for _, key in keyed]
    sections = [
        np.array([digest for digest, _ in keyed], np.uint64).tobytes(),
        np.concatenate([[0], np.cumsum([len(s) for s in strings])]).astype(np.int64).tobytes(),
        np.array([verdicts[key] for _, key in keyed], np.uint8).tobytes(),
        np.array(sorted(lengths), np.int64).tobytes(),
        b"".join(strings),
    ]
    padded = [s + b"\0" * (-len(s) % 8) for s in sections]
    return np.array([x for s, p in zip(sections, padded) for x in (len(s), len(p))], np.int64).tobytes() + b"".join(padded)


class RuleArray:
    """A packed rule list, mapped from its file."""

    def __init__(self, path: str):
        whole = np.memmap(path, np.uint8, "r")
        head = np.frombuffer(whole[:80], np.int64).reshape(5, 2)
        at, parts = 80, []
        for size, padded in head:
            parts.append(whole[at : at + size])
            at += padded
        self.digests, self.offsets = parts[0].view(np.uint64), parts[1].view(np.int64)
        self.verdicts, self.lengths, self.strings = parts[2], parts[3].view(np.int64).tolist(), parts[4]

    def string(self, k: int) -> bytes:
        return self.strings[self.offsets[k] : self.offsets[k + 1]].tobytes()

    def find(self, keys: list[bytes]) -> np.ndarray:
        """The index of each key among the stored strings, or -1."""
        digests = np.fromiter(map(xxhash.xxh64_intdigest, keys), np.uint64, len(keys))
        first = np.searchsorted(self.digests, digests, "left")
        last = np.searchsorted(self.digests, digests, "right")
        found = np.full(len(keys), -1, np.int64)
        for k in np.flatnonzero(first < last).tolist():
            found[k] = next((x for x in range(first[k], last[k]) if self.string(x) == keys[k]), -1)
        return found


def candidates(host: str, path: str, lengths: list[int]) -> list[bytes]:
    """Every rule string that could fit, longest first; of equal length the longer host first."""
    if not host:
        return []
    labels = host.split(".")
    suffixes = [".".join(labels[k:]) for k in range(len(labels))]
    keys = [(s, path[:n]) for s in suffixes if s for n in lengths if n <= len(path)]
    return [(s + p).encode() for s, p in sorted(keys, key=lambda x: (-len(x[0]) - len(x[1]), -len(x[0])))]


def judge(urls: DataFrame, rules: list[tuple[str, str, str]], url_col: str = "url", default: str = "allow") -> DataFrame:
    """urls with columns host, path, rule (null if none fits) and verdict (the rule's, else default).

    The packed rules are copied to the executors up to SHIP_LIMIT_BYTES; a longer list takes judge_by_join."""
    packed = pack_rules(rules)
    if len(packed) > SHIP_LIMIT_BYTES:
        frame = urls.sparkSession.createDataFrame(rules, "host string, path string, verdict string")
        return judge_by_join(urls, frame, url_col, default)
    name = ship_bytes(urls.sparkSession, "url-rules", packed)

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        array = RuleArray(SparkFiles.get(name))
        for batch in batches:
            keys: list[bytes] = []
            of: list[int] = []
            for k, (host, path) in enumerate(zip(batch["host"].to_pylist(), batch["path"].to_pylist())):
                own = candidates(host, path, array.lengths)
                keys += own
                of += [k] * len(own)
            hits = array.find(keys)
            rule: list[str | None] = [None] * batch.num_rows
            verdict = [default] * batch.num_rows
            for x in np.flatnonzero(hits >= 0)[::-1].tolist():  # the first hit of a url is its longest and is set last
                rule[of[x]] = keys[x].decode()
                verdict[of[x]] = "block" if array.verdicts[hits[x]] else "allow"
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(rule, pa.string()), pa.array(verdict, pa.string())], [*batch.schema.names, "rule", "verdict"])

    parsed = urls.withColumns({"host": url_host(F.col(url_col)), "path": url_path(F.col(url_col))}).drop("rule", "verdict")
    schema = StructType([*parsed.schema.fields, StructField("rule", StringType()), StructField("verdict", StringType())])
    return parsed.mapInArrow(probe, schema)


def judge_by_join(urls: DataFrame, rules: DataFrame, url_col: str = "url", default: str = "allow") -> DataFrame:
    """The same result for a rule table of any size: candidate strings of the distinct (host, path)
    pairs are joined to the rules on digest and full string; the urls get the longest rule back."""
    parsed = urls.withColumns({"host": url_host(F.col(url_col)), "path": url_path(F.col(url_col))}).drop("rule", "verdict")
    kept = (
        rules.where("host is not null and host <> ''")
        .select(F.concat("host", F.coalesce("path", F.lit(""))).alias("key"), F.length(F.coalesce("path", F.lit(""))).alias("n"), (F.col("verdict") == "block").cast("int").alias("blocks"))
        .groupBy("key", "n").agg(F.max("blocks").alias("blocks")).withColumn("digest", F.xxhash64("key"))
    )
    lengths = kept.select("n").distinct()
    labels = F.split("host", r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda k: F.array_join(F.slice(labels, k, F.size(labels)), "."))
    pairs = parsed.select("host", "path").distinct()
    keys = (
        pairs.where("host <> ''").withColumn("n", F.explode(F.sequence(F.lit(0), F.length("path")))).join(lengths, "n")
        .withColumn("suffix", F.explode(suffixes)).where("suffix <> ''")
        .select("host", "path", F.length("suffix").alias("host_n"), F.concat("suffix", F.expr("left(path, n)")).alias("key"))
        .withColumn("digest", F.xxhash64("key"))
    )
    best = (
        keys.join(kept.drop("n"), ["digest", "key"])
        .groupBy("host", "path").agg(F.max_by(F.struct("key", "blocks"), F.struct(F.length("key"), "host_n")).alias("best"))
    )
    return (
        parsed.join(best, ["host", "path"], "left")
        .withColumns({"rule": F.col("best.key"), "verdict": F.when(F.col("best.blocks") == 1, "block").when(F.col("best.blocks") == 0, "allow").otherwise(default)})
        .select(*parsed.columns, "rule", "verdict")
    )
