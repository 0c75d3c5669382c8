"""Secret scan: fixed patterns, and strings in a sensitive context that a primed compressor can't shorten.

Novelty of a candidate: the bytes that zstandard adds to the code or text around it for the candidate, over
the candidate's length. The compressor is primed with a dictionary of identifiers: IDENTIFIERS and the
first WORDS words of a public tokenizer's vocabulary, whose path is a parameter; the driver reads it, workers
get it. Prose, paths, identifiers and repeats are shortened; a key is not. A candidate over WINDOW
characters is cut evenly into windows, each after what precedes it in the candidate too, and is as novel
as its most novel window: longer runs of literals are coded by their alphabet, which would shorten any key.
One in small or capital letters only has fewer bits a letter, so less is asked of it. Copies of the candidate,
and of long parts of it, never stand in what surrounds it, and every run of the text that equals a novel
candidate has its verdict.

Defined results: a null text is empty and has no spans; texts are scanned whole; spans are in code
points, end exclusive; repeated rows are scanned each. A text that no pattern and no sensitive word
can match is never sent to Python.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator
from functools import cache

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from strandmill.llm.shared import in_worker

#: Base patterns, in their listed order; fixed values.
ASSIGN = re.compile(r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
LONG_HEX = re.compile(r"[0-9a-f]{16,}")  # equal to HEX matches of 16 or more: a match is a maximal run
KINDS = ["assign", "access", "hex", "novel"]
#: Words that make what follows within REACH characters sensitive.
SENSITIVE = r"(?:passw(?:or)?d|pwd|secret|token|api[_-]?key|credential|private[_-]?key|access[_-]?key|signing[_-]?key|authorization|bearer)"
CONTEXT = re.compile(SENSITIVE, re.I | re.A)
LEAST_CHARS = 20
CANDIDATE = re.compile(rf"[A-Za-z0-9+/_=.!@#$%^&*~-]{{{LEAST_CHARS},}}")
PART = re.compile(r"[A-Za-z0-9]{16,}")
REACH = 48
AROUND = 400
#: Marginal bytes a character from which a candidate is novel; one of letters of one case.
LEAST_NOVELTY, LEAST_ONE_CASE = 0.82, 0.64
#: Of a candidate, its last BEFORE characters stand before a window.
WINDOW, BEFORE = 40, 4096
#: The vocabulary (ranks of byte pairs, base 64) whose first words of four letters or more prime the compressor.
VOCABULARY, WORDS, CAPITALS, NEXT = "/opt/tokenizers/byte_bpe_50k.tiktoken", 12_000, 9_000, 60
#: Identifiers that code and configuration share; primes the compressor.
IDENTIFIERS = (
    "password username token secret api_key access_key client_id client_secret authorization bearer private_key "
    "public_key certificate connection_string database hostname localhost endpoint region bucket config settings "
    "environment variable default example placeholder changeme your_key_here insert_token_here http://www. https://api. "
    ".example.com .internal .local /usr/local/bin /etc/ssl/certs /home/user/ application/json content-type charset=utf-8 "
    "getElementById addEventListener toString valueOf prototype function return const import from class def self "
    "AbstractFactoryBeanProvider ConfigurationManager AuthenticationService UserRepository RequestHandler "
    "get_connection_pool_size max_retry_count timeout_seconds session_identifier refresh_token_endpoint "
    "2019-01-01T00:00:00.000Z 2020-10-20 2021-11-21 2022-12-22 2023-11-23 2024-02-24 2025-03-25 2026-04-26 12:30:45 v1.2.3 v2.0.1 "
    "src/main/java/com/ src/test/ node_modules/ github.com/ .controller.js .service.py _id _name _key _url x86_64 Win64 Linux Mozilla/5.0 "
    "abcdefghijklmnopqrstuvwxyz ABCDEFGHIJKLMNOPQRSTUVWXYZ 0123456789 0000000000000000 1111111111 xxxxxxxxxxxxxxxx "
)
GATE = rf"(?i:{SENSITIVE}|apikey)|AKIA|[0-9a-f]{{16}}"


@cache
def identifiers(path: str = VOCABULARY) -> tuple[bytes, bytes]:
    """The dictionary, what it holds most often last, and a text of the vocabulary's next words, which the dictionary lacks."""
    words: dict[bytes, None] = {}
    with open(path, "rb") as file:
        for line in file:
            word = base64.b64decode(line.split()[0]).strip()
            if len(word) >= 4 and word.isascii() and word.isalpha():
                words.setdefault(word)
                if len(words) == WORDS + NEXT:
                    break
    flat = list(words)[:WORDS][::-1]
    return b" ".join([*(w.upper() for w in flat[-CAPITALS:]), *flat, IDENTIFIERS.encode()]), b"_".join(list(words)[WORDS:])


class Novelty:
    """Measures candidates with a compressor primed once."""

    def __init__(self, dictionary: bytes, base: bytes):
        primed = zstandard.ZstdCompressionDict(dictionary, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        how = zstandard.ZstdCompressionParameters.from_level(12, window_log=19, hash_log=18, chain_log=18, search_log=6, min_match=3, target_length=64, strategy=zstandard.STRATEGY_BTULTRA2, write_content_size=False, write_checksum=False, write_dict_id=False)
        self.packer = zstandard.ZstdCompressor(dict_data=primed, compression_params=how)
        self.base = base  # stands first: few characters around a candidate would leave it to pay for the frame

    def of(self, candidate: str, around: str) -> float:
        """Marginal compressed bytes of candidate over its length."""
        before, data = self.base + around.encode("utf-8", "surrogatepass") + b"\n", candidate.encode()
        return (len(self.packer.compress(before + data + b"\n")) - len(self.packer.compress(before + b"\n"))) / len(data)

    def tells(self, candidate: str, around: str) -> bool:
        """Whether a window of the candidate is novel."""
        if re.fullmatch(r"[A-Z0-9]+(_[A-Z0-9]+)+", candidate):  # a constant's name
            candidate = candidate.lower()
        least = LEAST_ONE_CASE if re.fullmatch(r"[a-z]+|[A-Z]+", candidate) else LEAST_NOVELTY
        n = -(-len(candidate) // WINDOW)
        cuts = [len(candidate) * k // n for k in range(n + 1)]
        return any(self.of(candidate[a:b], around + candidate[max(0, a - BEFORE) : a]) >= least for a, b in zip(cuts, cuts[1:]))


def surroundings(text: str, start: int, stop: int) -> str:
    """AROUND characters on both sides of a candidate, copies of it and of its long mixed parts blanked."""
    token = text[start:stop]
    far = AROUND + len(token)  # a copy that the cut at AROUND would split is seen whole
    left, right = text[max(0, start - far) : start], text[stop : stop + far]
    for part in (token, *(p for p in PART.findall(token) if mixed(p))):
        left, right = left.replace(part, " " * len(part)), right.replace(part, " " * len(part))
    return left[-AROUND:] + right[:AROUND]


def mixed(token: str) -> bool:
    return bool(re.search(r"[0-9]", token) and re.search(r"[A-Za-z]", token))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind's number, end) of the base patterns' matches."""
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 12]
    found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 18]
    found += [(m.start(), 2, m.end()) for m in LONG_HEX.finditer(text)]
    return sorted(found)


def novel_spans(text: str, taken: list[tuple[int, int, int]], measure: Novelty) -> list[tuple[int, int, int]]:
    """Incompressible strings that follow a sensitive word and of which base spans leave LEAST_CHARS characters or more."""
    ordered = sorted((s, e) for s, _, e in taken)
    at, last = 0, -1
    tried: dict[tuple[int, int], str] = {}
    novel: set[str] = set()

    def unclaimed(start: int, stop: int) -> bool:
        nonlocal at
        while at < len(ordered) and ordered[at][1] <= start:
            at += 1
        free, left, k = 0, start, at
        while k < len(ordered) and ordered[k][0] < stop:
            free, left, k = free + max(0, ordered[k][0] - left), max(left, ordered[k][1]), k + 1
        return free + max(0, stop - left) >= LEAST_CHARS

    for word in CONTEXT.finditer(text):
        end = word.end()
        # the first LEAST_CHARS characters place a candidate, which then runs to its own end
        while m := CANDIDATE.search(text, max(end, last), end + REACH + LEAST_CHARS):
            m = CANDIDATE.match(text, m.start())
            start, last = m.span()
            token = m[0]
            if unclaimed(start, last):
                tried[start, last] = token
                if token not in novel and measure.tells(token, surroundings(text, start, last)):
                    novel.add(token)
    if not novel:
        return []
    found = {span for span, token in tried.items() if token in novel}
    at, last = 0, -1
    near = sorted(found)
    k = 0
    for m in CANDIDATE.finditer(text):
        while k < len(near) and near[k][1] <= m.start():
            k += 1
        if m[0] in novel and (k == len(near) or near[k][0] >= m.end()) and unclaimed(*m.span()):
            found.add(m.span())
    return [(start, 3, stop) for start, stop in sorted(found)]


def scan_text(text: str | None, measure: Novelty) -> list[tuple[int, int, int]]:
    """All spans of a text as (start, kind's number, end), in order."""
    if not text:
        return []
    base = base_spans(text)
    return sorted(base + novel_spans(text, base, measure))


def joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


def scan(docs: DataFrame, text_col: str = "text", keep: tuple[str, ...] = ("doc_id",), vocabulary: str = VOCABULARY) -> DataFrame:
    """The keep columns and spans: array of (kind, start, end)."""
    span = ArrayType(StructType([StructField("kind", StringType()), StructField("start", LongType()), StructField("end", LongType())]))
    known = identifiers(vocabulary)
    item = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])

    def run(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        measure = Novelty(*known)
        for column in columns:
            yield pa.array([[{"kind": KINDS[k], "start": s, "end": e} for s, k, e in scan_text(t.as_py(), measure)] for t in column], pa.list_(item))

    return docs.select(*keep, in_worker(run, span)(F.when(F.col(text_col).rlike(GATE), F.col(text_col))).alias("spans"))


def digest(scanned: DataFrame) -> DataFrame:
    """Counts, base digest and span list of scanned rows, with doc_id."""
    text = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
    base = F.filter("spans", lambda s: s["kind"] != "novel")
    return scanned.select("doc_id", count("assign").alias("n_assign"), count("access").alias("n_access"), count("hex").alias("n_hex"), F.sha2(text(base), 256).alias("base_sha256"), text(F.col("spans")).alias("spans"))


def redacted(text: str | None, mark: str, measure: Novelty) -> str | None:
    """text with each span (overlapping ones merged) replaced by mark; None if it has none."""
    out, at = [], 0
    for s, _, e in scan_text(text, measure):
        if s >= at:
            out.append(text[at:s] + mark)
        at = max(at, e)
    return "".join(out) + text[at:] if out else None


def redact(docs: DataFrame, text_col: str = "text", mark: str = "[SECRET]", vocabulary: str = VOCABULARY) -> DataFrame:
    """docs with each span of text_col (overlapping ones merged) replaced by mark; other columns as they were.
    Rows without a span are unchanged; a null text stays null."""

    known = identifiers(vocabulary)

    def run(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        measure = Novelty(*known)
        for column in columns:
            yield pa.array([redacted(t.as_py(), mark, measure) for t in column], pa.string())

    text = F.col(text_col)
    return docs.withColumn(text_col, F.coalesce(in_worker(run, StringType())(F.when(text.rlike(GATE), text)), text))
