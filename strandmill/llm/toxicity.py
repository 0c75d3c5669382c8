"""Toxicity by a convolutional text classifier over hashed word embeddings, in numpy.

A word's embedding is the mean of rows of a hashed table: one row for the word, one for each of its
byte n-grams. Filters of several widths run over the words of a whole text, each filter's largest
response is kept, and a linear layer on the rectified maxima gives a log-odds. It is trained by
backpropagation through the maxima on a bounded sample of labelled rows: SAMPLE rows of each language
and label (fewer, 16 at least, of more than FULL_LANGUAGES languages), chosen by hash. Of a longer
text of label 0 a window of TRAIN_CHARS characters is read; one of label 1 is then not learned from, as its
cause could lie outside. A fourth of the sample is kept out of training and calibrates, for each
language, the log-odds at which a text counts as toxic; scores are shifted so that it lies at CUT. The
language is the one that the same hashed rows make likeliest: at prediction only the text is read.

Defined results: a null or empty text is scored as one without words; without learnable rows of
both labels every score is 0; a document with both labels is toxic; a null id is neither learned from
nor held out; languages without CALIBRATE calibration rows of a label share one threshold; repeated
rows are scored each, and learned from once; an empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import SparkFiles
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from strandmill.llm.shared import cut, in_worker, ship_bytes
from strandmill.llm.words import WORD_BYTES

BUCKETS, LANGUAGE_BUCKETS, GRAMS = 1 << 18, 1 << 14, (3, 4, 5)
DIMS, FILTERS, WIDTHS = 8, 8, (1, 2, 3)
SAMPLE, TRAIN_CHARS, FULL_LANGUAGES, CALIBRATE = 320, 16_000, 32, 4
EPOCHS, BATCH, RATE, SMOOTH = 4, 32, 0.05, 1.0
CUT, HELD = 0.3, 2
#: Words in a slice of the worker, distinct words that it remembers.
SLICE, REMEMBERED = 1 << 17, 1 << 17


def remainder(id_col: str) -> Column:
    return F.crc32(F.col(id_col).cast("string")) % 4


def buckets_of(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Table rows of each word, flat, and where each word's begin."""
    joined = np.frombuffer(b"".join(b"<%b>" % w for w in words), np.uint8).astype(np.uint64)
    sizes = np.array([len(w) + 2 for w in words], np.int64)
    ends = np.cumsum(sizes)
    rows = [np.array([xxhash.xxh3_64_intdigest(w) for w in words], np.uint64)]
    owners = [np.arange(len(words))]
    owner = np.repeat(np.arange(len(words)), sizes)
    left = ends[owner] - np.arange(len(joined))  # bytes from here to the word's end
    for size in GRAMS:
        h = np.full(max(0, len(joined) - size + 1), size, np.uint64)
        for k in range(size):
            h = h * np.uint64(0x100000001B3) + joined[k : k + len(h)]
        inside = left[: len(h)] >= size
        h = h[inside] * np.uint64(0x9E3779B97F4A7C15)
        rows.append(h ^ (h >> np.uint64(29)))
        owners.append(owner[: len(inside)][inside])
    flat, owner = np.concatenate(rows), np.concatenate(owners)
    order = np.argsort(owner, kind="stable")
    return (flat[order] & np.uint64(BUCKETS - 1)).astype(np.int32), np.searchsorted(owner[order], np.arange(len(words)))


def means(table: np.ndarray, rows: np.ndarray, starts: np.ndarray, step: int = 1 << 16) -> np.ndarray:
    """The mean of each word's rows of table; every word has one at least."""
    out = np.zeros((len(starts), table.shape[1]), np.float32)
    stops = np.append(starts[1:], len(rows))
    for low in range(0, len(rows), step):
        first = np.searchsorted(stops, low, "right")
        last = np.searchsorted(starts, min(len(rows), low + step), "left")
        at = np.maximum(starts[first:last], low) - low
        out[first:last] += np.add.reduceat(table[rows[low : low + step]], at, axis=0)
    return out / (stops - starts)[:, None].astype(np.float32)


class Classifier:
    """Embeddings, filters of each width (width x DIMS x FILTERS), biases, the last layer, languages and their cuts."""

    def __init__(self, weights: dict[str, np.ndarray], languages: np.ndarray, cuts: np.ndarray):
        self.w, self.languages, self.cuts = weights, languages, cuts

    @classmethod
    def fresh(cls, seed: int = 7) -> Classifier:
        draw = np.random.default_rng(seed)
        w = {"embed": draw.normal(0, 0.1, (BUCKETS, DIMS)), "bias": np.zeros(len(WIDTHS) * FILTERS), "last": draw.normal(0, 0.3, len(WIDTHS) * FILTERS), "prior": np.zeros(1)}
        w |= {f"conv{k}": draw.normal(0, (k * DIMS) ** -0.5, (k, DIMS, FILTERS)) for k in WIDTHS}
        return cls({n: v.astype(np.float32) for n, v in w.items()}, np.zeros((LANGUAGE_BUCKETS, 1), np.float32), np.zeros(2, np.float32))

    def filters(self) -> np.ndarray:
        """All filters side by side: DIMS x (widths' offsets, FILTERS each)."""
        return np.concatenate([self.w[f"conv{k}"][j] for k in WIDTHS for j in range(k)], axis=1)

    @staticmethod
    def responses(parts: np.ndarray) -> np.ndarray:
        """parts: words x (offsets x FILTERS). The response of each filter at each word: as many words less the widest's reach."""
        n = len(parts) - max(WIDTHS) + 1
        out, at = np.empty((n, len(WIDTHS) * FILTERS), np.float32), 0
        for i, k in enumerate(WIDTHS):
            own = out[:, i * FILTERS : (i + 1) * FILTERS]
            own[:] = parts[:n, at : at + FILTERS]
            for j in range(1, k):
                own += parts[j : j + n, at + j * FILTERS : at + (j + 1) * FILTERS]
            at += k * FILTERS
        return out

    def logit(self, maxima: np.ndarray) -> np.ndarray:
        """Of texts' largest responses; a text without words has none, which count as -infinity."""
        return np.maximum(maxima + self.w["bias"], 0) @ self.w["last"] + self.w["prior"][0]

    def to_bytes(self) -> bytes:
        parts = [self.w[n] for n in sorted(self.w)] + [self.languages, self.cuts]
        return b"".join(np.ascontiguousarray(p, np.float32).tobytes() for p in parts)

    @classmethod
    def from_bytes(cls, data: bytes, languages: int) -> Classifier:
        net = cls.fresh()
        flat, at = np.frombuffer(data, np.float32), 0
        for n in sorted(net.w):
            net.w[n] = flat[at : at + net.w[n].size].reshape(net.w[n].shape)
            at += net.w[n].size
        table = LANGUAGE_BUCKETS * languages
        return cls(net.w, flat[at : at + table].reshape(LANGUAGE_BUCKETS, languages), flat[at + table :])


class Reader:
    """Scores whole texts; remembers what the words it met contribute."""

    def __init__(self, net: Classifier):
        self.net, self.filters = net, net.filters()
        self.forget()

    def forget(self) -> None:
        self.known: dict[bytes, int] = {b"": 0}  # 0 is no word
        self.parts = np.zeros((1, self.filters.shape[1]), np.float32)
        self.tongue = np.zeros((1, self.net.languages.shape[1]), np.float32)

    def numbers(self, words: list[bytes]) -> np.ndarray:
        """The words' rows of parts and tongue, made for new words."""
        if len(self.known) > REMEMBERED:
            self.forget()
        known = self.known
        if new := [w for w in dict.fromkeys(words) if w not in known]:
            rows, starts = buckets_of(new)
            self.parts = np.vstack([self.parts, means(self.net.w["embed"], rows, starts) @ self.filters])
            self.tongue = np.vstack([self.tongue, means(self.net.languages, rows & (LANGUAGE_BUCKETS - 1), starts)])
            known.update(zip(new, range(len(known), len(known) + len(new))))
        return np.fromiter(map(known.__getitem__, words), np.int64, len(words))

    def read(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Log-odds before calibration and language number of each text; texts are read in slices of about SLICE words."""
        reach = max(WIDTHS) - 1
        maxima = np.full((len(texts), self.net.w["bias"].size), -np.inf, np.float32)
        tongues = np.zeros((len(texts), self.net.languages.shape[1]))
        flat: list[bytes] = []
        owners, starts, stops = [], [], []

        def flush() -> None:
            if starts:
                at = self.numbers(flat)
                found = self.net.responses(self.parts[at])
                maxima[owners] = np.maximum(maxima[owners], np.maximum.reduceat(np.vstack([found, found[-1:]]), np.ravel(np.column_stack([starts, stops])), axis=0)[::2])
                tongues[owners] += np.add.reduceat(np.vstack([self.tongue[at], self.tongue[:1]]), np.ravel(np.column_stack([starts, stops])), axis=0)[::2]
            for some in (flat, owners, starts, stops):
                some.clear()

        for k, text in enumerate(texts):
            for words in sliced(text, reach):
                fresh = len(words) - reach
                if len(flat) + len(words) > SLICE or owners and owners[-1] == k:  # a text has one place in a flush
                    flush()
                owners.append(k)
                starts.append(len(flat))
                stops.append(len(flat) + fresh)
                flat.extend(words)
        flush()
        return self.net.logit(maxima), tongues.argmax(1)


def sliced(text: bytes, reach: int, size: int = 1 << 20) -> Iterator[list[bytes]]:
    """The words of text in slices of about size bytes, each followed by the next reach words, empty ones at the end."""
    flat = text.translate(WORD_BYTES)
    held: list[bytes] = []
    low = 0
    while low < len(flat):
        high = flat.find(b" ", low + size)
        high = len(flat) if high < 0 else high
        held += flat[low:high].split()
        low = high
        if low < len(flat) and len(held) > reach:
            yield held
            held = held[-reach:] if reach else []
    if held:
        yield held + [b""] * reach


def leanings(docs: list[np.ndarray], labels: np.ndarray, groups: np.ndarray, rows: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Of each hashed row, the log of the toxic texts that hold it over those expected from its group's other texts, smoothed."""
    stops = np.append(starts[1:], len(rows))
    seen, expected = np.zeros(BUCKETS), np.zeros(BUCKETS)
    weight = {g: (labels[groups == g] == 1).sum() / max(1, (labels[groups == g] == 0).sum()) for g in np.unique(groups)}
    for d, y, g in zip(docs, labels, groups):
        words = np.unique(d)
        own = np.unique(np.concatenate([rows[starts[w] : stops[w]] for w in words]))
        if y:
            seen[own] += 1
        else:
            expected[own] += weight[g]
    return np.log((seen + SMOOTH) / (expected + SMOOTH)).astype(np.float32)


def train(texts: list[bytes], labels: np.ndarray, groups: np.ndarray, epochs: int = EPOCHS, seed: int = 7) -> Classifier:
    """By Adagrad on batches with as many texts of either label; the table's first column begins at the rows' leanings."""
    net, draw = Classifier.fresh(seed), np.random.default_rng(seed)
    reach, w = max(WIDTHS) - 1, net.w
    vocabulary: dict[bytes, int] = {}
    docs = [np.array([vocabulary.setdefault(x, len(vocabulary)) for part in sliced(t, 0) for x in part] or [vocabulary.setdefault(b"", len(vocabulary))], np.int64) for t in texts]
    rows, starts = buckets_of(list(vocabulary))
    stops = np.append(starts[1:], len(rows))
    w["embed"][:, 0] = leanings(docs, labels, groups, rows, starts)
    past = {n: np.full_like(v, 1e-3) for n, v in w.items()}
    by_label = [np.flatnonzero(labels == y) for y in (0, 1)]
    steps = max(1, -(-2 * max(map(len, by_label)) // BATCH))
    for _ in range(epochs):
        order = [np.concatenate([draw.permutation(some) for _ in range(-(-steps * BATCH // 2 // len(some)))]) for some in by_label]
        for step in range(steps):
            chosen = np.concatenate([o[step * BATCH // 2 : (step + 1) * BATCH // 2] for o in order])
            _step(net, [docs[k] for k in chosen], labels[chosen], rows, starts, stops, past, reach)
    return net


def _step(net: Classifier, docs: list[np.ndarray], labels: np.ndarray, rows: np.ndarray, starts: np.ndarray, stops: np.ndarray, past: dict[str, np.ndarray], reach: int) -> None:
    w = net.w
    words, flat = np.unique(np.concatenate(docs), return_inverse=True)
    sizes = stops[words] - starts[words]
    own = np.repeat(starts[words] - np.append(0, np.cumsum(sizes)[:-1]), sizes) + np.arange(sizes.sum())
    table_rows, first = rows[own], np.append(0, np.cumsum(sizes)[:-1])
    embed = np.vstack([means(w["embed"], table_rows, first), np.zeros((1, DIMS), np.float32)])  # the last is no word
    none, at, maxima, places = len(words), 0, [], []
    padded, low = [], 0
    for d in docs:
        padded += [flat[at : at + len(d)], np.full(reach, none)]
        at += len(d)
    line = np.concatenate(padded)
    found = net.responses((embed @ net.filters())[line])
    for d in docs:
        best = found[low : low + len(d)].argmax(0)
        places.append(low + best)
        maxima.append(found[low + best, np.arange(found.shape[1])])
        low += len(d) + reach
    places, maxima = np.array(places), np.array(maxima)
    hidden = np.maximum(maxima + w["bias"], 0)
    wrong = (1 / (1 + np.exp(-(hidden @ w["last"] + w["prior"][0]))) - labels).astype(np.float32) / len(docs)
    back = wrong[:, None] * w["last"][None, :] * (hidden > 0)
    grads = {"last": wrong @ hidden, "prior": np.array([wrong.sum()], np.float32), "bias": back.sum(0)}
    g_words = np.zeros_like(embed)
    for i, k in enumerate(WIDTHS):
        own_places, own_back = places[:, i * FILTERS : (i + 1) * FILTERS], back[:, i * FILTERS : (i + 1) * FILTERS]
        grads[f"conv{k}"] = np.empty_like(w[f"conv{k}"])
        for j in range(k):
            at = line[own_places + j]
            grads[f"conv{k}"][j] = np.einsum("dfe,df->ef", embed[at], own_back)
            np.add.at(g_words, at.ravel(), (own_back[:, :, None] * w[f"conv{k}"][j].T[None]).reshape(-1, DIMS))
    for n, g in grads.items():
        past[n] += g * g
        w[n] -= (RATE * g / np.sqrt(past[n])).astype(np.float32)
    moved = np.flatnonzero(np.abs(g_words[:-1]).sum(1))
    if not len(moved):
        return
    sizes = sizes[moved]
    spread = np.repeat(g_words[moved] / sizes[:, None], sizes, axis=0)
    touched, back_to = np.unique(np.concatenate([table_rows[first[m] : first[m] + s] for m, s in zip(moved, sizes)]), return_inverse=True)
    g = np.zeros((len(touched), DIMS), np.float32)
    np.add.at(g, back_to, spread)
    past["embed"][touched] += g * g
    w["embed"][touched] -= RATE * g / np.sqrt(past["embed"][touched])


def tell_languages(texts: list[bytes], numbers: np.ndarray, count: int) -> np.ndarray:
    """Of each hashed row and language the log-probability, less the languages' mean."""
    seen = np.ones((LANGUAGE_BUCKETS, max(1, count)))
    for number in range(count):
        words: dict[bytes, None] = {}
        for k in np.flatnonzero(numbers == number):
            for part in sliced(texts[k], 0):
                words.update(dict.fromkeys(part))
        if words:
            rows, _ = buckets_of(list(words))
            seen[:, number] += np.bincount(rows & (LANGUAGE_BUCKETS - 1), minlength=LANGUAGE_BUCKETS)
    share = np.log(seen / seen.sum(0))
    return (share - share.mean(1, keepdims=True)).astype(np.float32)


def best_cut(logits: np.ndarray, labels: np.ndarray) -> float:
    """Midway between the two log-odds whose parting gives the highest F1; the widest gap of those."""
    order = np.argsort(logits, kind="stable")
    x, y = logits[order], labels[order]
    caught = np.append(np.cumsum(y[::-1])[::-1], 0)  # toxic ones at k or above
    f1 = 2 * caught / np.maximum(1, np.arange(len(x), -1, -1) + y.sum())
    edge = np.append(x, x[-1] + 2.0)
    gap = np.diff(np.append(x[0] - 2.0, edge))
    k = max(range(len(f1)), key=lambda i: (round(float(f1[i]), 9), gap[i]))
    return float(edge[k] - gap[k] / 2)


def learn(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", label_col: str = "toxic") -> Classifier | None:
    """A calibrated classifier from the labelled rows that are not held out; None without both labels."""
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"), F.coalesce(F.col(text_col), F.lit("")).alias("text"), remainder(id_col).alias("part"))
    rows = rows.where(F.col("id").isNotNull() & (F.col("part") != HELD)).withColumn("h", F.xxhash64("id", "text"))
    told = labels.select(F.col(id_col).alias("of"), F.col(label_col).cast("int").alias("y")).where("of is not null and y in (0, 1)").groupBy("of").agg(F.max("y").alias("y"))
    known = cut(rows.select("id", "lang", "h", F.length("text").alias("n")).join(told, F.col("id") == F.col("of")).where((F.col("y") == 0) | (F.col("n") <= TRAIN_CHARS)).select("lang", "y", "h").distinct())
    counts = known.groupBy("lang", "y").agg(F.count(F.lit(1)).alias("n"))
    quota = max(16, SAMPLE * FULL_LANGUAGES // max(FULL_LANGUAGES, counts.select("lang").distinct().count()))
    share = F.shiftrightunsigned(F.xxhash64("h"), 11).cast("double") / float(1 << 53)
    some = cut(known.join(counts, ["lang", "y"]).where(share < (1.3 * quota + 16) / F.col("n")).select("lang", "y", F.col("h").alias("of")))
    room = F.greatest(F.length("text") - TRAIN_CHARS, F.lit(0)) + 1
    window = F.substring("text", (F.pmod("h", room) + 1).cast("int"), F.lit(TRAIN_CHARS)).cast("binary")
    # a hash that many rows share is one row, chosen by each task before rows meet
    found = rows.drop("lang").join(F.broadcast(some) if some.count() <= 200_000 else some, F.col("h") == F.col("of")).select("lang", "y", "h", window.alias("text")).dropDuplicates(["lang", "y", "h"]).collect()
    taken: dict[tuple, int] = {}
    kept = []
    for row in sorted(found, key=lambda r: (r["lang"], r["y"], r["h"])):
        place = row["lang"], row["y"]
        taken[place] = taken.get(place, 0) + 1
        if taken[place] <= quota:
            kept.append((bytes(row["text"]), row["lang"], row["y"], taken[place] % 4 == 0))
    return calibrated([k[0] for k in kept], [k[1] for k in kept], np.array([k[2] for k in kept], np.int64), np.array([k[3] for k in kept], bool))


def calibrated(texts: list[bytes], langs: list[str], labels: np.ndarray, aside: np.ndarray) -> Classifier | None:
    """Trained on the texts not aside; cuts of each language, and of all, from those aside or, if they lack a label, from all."""
    use = np.flatnonzero(~aside)
    if len(np.unique(labels[use])) < 2:
        use = np.arange(len(texts))
    if len(np.unique(labels)) < 2:
        return None
    names = sorted(set(langs))
    number = np.array([names.index(x) for x in langs])
    net = train([texts[k] for k in use], labels[use], number[use])
    net.languages = tell_languages([texts[k] for k in use], number[use], len(names))
    logits, tongue = Reader(net).read(texts)
    judged = aside if len(np.unique(labels[aside])) == 2 else np.ones(len(texts), bool)
    overall = best_cut(logits[judged], labels[judged])
    cuts = [overall] * len(names)
    for k in range(len(names)):
        own = judged & (tongue == k)
        if min((labels[own] == y).sum() for y in (0, 1)) >= CALIBRATE:
            cuts[k] = best_cut(logits[own], labels[own])
    net.cuts = np.array(cuts, np.float32)
    return net


def score(docs: DataFrame, net: Classifier | None, text_col: str = "text") -> Column:
    """The toxicity of each text, 0 to 1; CUT is its language's threshold. Only texts go to Python."""
    if net is None:
        return F.lit(0.0)
    name, languages = ship_bytes(docs.sparkSession, "toxicity", net.to_bytes()), net.languages.shape[1]
    base = float(np.log(CUT / (1 - CUT)))

    def run(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        with open(SparkFiles.get(name), "rb") as file:
            reader = Reader(Classifier.from_bytes(file.read(), languages))
        for column in columns:
            logits, tongue = reader.read([t.as_py() or b"" for t in column]) if len(column) else (np.zeros(0), np.zeros(0, int))
            shifted = np.clip(logits.astype(np.float64) - reader.net.cuts[tongue] + base, -700, 700)
            yield pa.array(1 / (1 + np.exp(-shifted)), pa.float64())

    return in_worker(run, DoubleType())(F.coalesce(F.col(text_col), F.lit("")).cast("binary"))


def detect(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", label_col: str = "toxic") -> DataFrame:
    """doc_id, held_out, score and predicted of every row, learned from the labelled rows that are not held out."""
    net = learn(docs, labels, id_col, text_col, lang_col, label_col)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(remainder(id_col) == HELD, F.lit(False)).alias("held_out"), score(docs, net, text_col).alias("score"))
    return rows.withColumn("predicted", (F.col("score") >= CUT).cast("int"))
