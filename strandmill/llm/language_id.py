"""Language ID by a bidirectional gated recurrent network over bytes, in numpy.

The network reads windows of WINDOW bytes of the UTF-8 text in both directions, each window from a
zero state, and gives every position probabilities of the languages; a document's probabilities are the
mean over all its positions, of all its windows. It is trained on the driver by backpropagation
through time on a bounded sample of labelled rows (SAMPLE_DOCS documents a language, fewer, one at
least, of more than FULL_LANGUAGES languages; PIECES pieces of PIECE_CHARS characters each, chosen by
hash), of every language; prediction covers whole texts of all rows and sees nothing but the text.

Defined results: a null text or one without a letter is "und" with score 0, as is every text if there
are no labelled rows; a null id counts as not held out and isn't learned from; ties go to the
language that sorts first; repeated rows are predicted each, and learned from once; an empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from strandmill.llm.shared import cut, free_name, in_worker

SAMPLE_DOCS, PIECES, PIECE_CHARS, FULL_LANGUAGES = 256, 4, 160, 64
HIDDEN, WINDOW, ROWS = 8, 128, 1024
EPOCHS, BATCH, RATE, TRAIN_WINDOW = 5, 128, 0.02, 64
HELD = 1


def remainder(id_col: str) -> Column:
    return F.crc32(F.col(id_col).cast("string")) % 3


class Network:
    """Gates z, r and candidate n of each direction from tables of 256 byte inputs and H x 3H matrices."""

    def __init__(self, labels: list[str], weights: dict[str, np.ndarray]):
        self.labels, self.w = labels, weights

    @classmethod
    def fresh(cls, labels: list[str], hidden: int = HIDDEN, seed: int = 5) -> Network:
        draw = np.random.default_rng(seed)
        k = len(labels)
        w = {"out": draw.normal(0, 0.3, (2 * hidden, k)), "bias": np.zeros(k)}
        for d in "fb":
            w |= {f"in_{d}": draw.normal(0, 0.5, (256, 3 * hidden)), f"rec_{d}": draw.normal(0, hidden**-0.5, (hidden, 3 * hidden))}
        return cls(labels, {n: v.astype(np.float32) for n, v in w.items()})

    def states(self, bytes_: np.ndarray, d: str, trace: list | None = None) -> np.ndarray:
        """bytes_: time x rows, in reading order. The states after each byte: time x rows x H."""
        table, rec = self.w[f"in_{d}"].copy(), self.w[f"rec_{d}"].copy()
        h_n = rec.shape[0]
        table[:, : 2 * h_n] *= 0.5  # sigmoid(x) = (1 + tanh(x / 2)) / 2
        rec[:, : 2 * h_n] *= 0.5
        steps, rows = bytes_.shape
        out = np.empty((steps, rows, h_n), np.float32)
        h = np.zeros((rows, h_n), np.float32)
        gates, act = np.empty((rows, 3 * h_n), np.float32), np.empty((rows, 3 * h_n), np.float32)
        for t in range(steps):
            np.take(table, bytes_[t], axis=0, out=gates, mode="clip")
            np.matmul(h, rec, out=act)
            zr = np.tanh(gates[:, : 2 * h_n] + act[:, : 2 * h_n])
            zr *= 0.5
            zr += 0.5
            own = act[:, 2 * h_n :]
            n = np.tanh(gates[:, 2 * h_n :] + zr[:, h_n:] * own)
            if trace is not None:
                trace.append((h, zr[:, :h_n].copy(), zr[:, h_n:].copy(), own.copy(), n))
            h = n + zr[:, :h_n] * (h - n)
            out[t] = h
        return out

    def positions(self, bytes_: np.ndarray) -> np.ndarray:
        """Probabilities of each position: time x rows x languages."""
        both = np.concatenate([self.states(bytes_, "f"), self.states(bytes_[::-1], "b")[::-1]], axis=2)
        logits = both.reshape(-1, both.shape[2]) @ self.w["out"] + self.w["bias"]
        logits -= logits.max(1, keepdims=True)
        np.exp(logits, out=logits)
        logits /= logits.sum(1, keepdims=True)
        return logits.reshape(*bytes_.shape, -1)

    def gradients(self, bytes_: np.ndarray, label: np.ndarray) -> tuple[dict[str, np.ndarray], float]:
        """Of the mean cross-entropy over all positions, by backpropagation through time; and that mean."""
        traces: dict[str, list] = {"f": [], "b": []}
        orders = {"f": bytes_, "b": bytes_[::-1]}
        states = {d: self.states(orders[d], d, traces[d]) for d in "fb"}
        both = np.concatenate([states["f"], states["b"][::-1]], axis=2)
        steps, rows, width = both.shape
        flat = both.reshape(-1, width)
        logits = flat @ self.w["out"] + self.w["bias"]
        logits -= logits.max(1, keepdims=True)
        p = np.exp(logits)
        p /= p.sum(1, keepdims=True)
        target = np.tile(label, steps)
        loss = float(-np.log(p[np.arange(len(p)), target] + 1e-9).mean())
        p[np.arange(len(p)), target] -= 1
        p /= len(p)
        grads = {"out": flat.T @ p, "bias": p.sum(0)}
        back = (p @ self.w["out"].T).reshape(steps, rows, width)
        h_n = width // 2
        for d, upper in (("f", back[:, :, :h_n]), ("b", back[::-1, :, h_n:])):
            rec = self.w[f"rec_{d}"]
            g_rec, g_in = np.zeros_like(rec), np.zeros_like(self.w[f"in_{d}"])
            dh = np.zeros((rows, h_n), np.float32)
            pre = np.empty((rows, 3 * h_n), np.float32)
            for t in range(steps - 1, -1, -1):
                h, z, r, own, n = traces[d][t]
                dh = dh + upper[t]
                dn = dh * (1 - z) * (1 - n * n)
                pre[:, :h_n] = dh * (h - n) * z * (1 - z)
                pre[:, h_n : 2 * h_n] = dn * own * r * (1 - r)
                pre[:, 2 * h_n :] = dn * r
                g_rec += h.T @ pre
                dh = dh * z + pre @ rec.T
                pre[:, 2 * h_n :] = dn
                np.add.at(g_in, orders[d][t], pre)
            grads |= {f"rec_{d}": g_rec, f"in_{d}": g_in}
        return grads, loss


def train(texts: list[bytes], labels: list[str], epochs: int = EPOCHS, seed: int = 5) -> Network | None:
    """A network for the sorted labels, by Adam on windows of TRAIN_WINDOW bytes; equal weight to each language."""
    names = sorted(set(labels))
    if not names:
        return None
    windows, target = [], []
    for text, label in zip(texts, labels):
        for low in range(0, max(1, len(text) - TRAIN_WINDOW + 1), TRAIN_WINDOW):
            piece = text[low : low + TRAIN_WINDOW]
            if len(piece) == TRAIN_WINDOW or not low:
                windows.append(np.frombuffer(piece.ljust(TRAIN_WINDOW, b" "), np.uint8))
                target.append(names.index(label))
    data, target = np.stack(windows), np.array(target)
    most = max(np.bincount(target, minlength=len(names)))
    draw = np.random.default_rng(seed)
    net = Network.fresh(names, seed=seed)
    first = {n: np.zeros_like(v) for n, v in net.w.items()}
    second = {n: np.zeros_like(v) for n, v in net.w.items()}
    step = 0
    for epoch in range(epochs):
        rows = np.concatenate([draw.choice(np.flatnonzero(target == k), most) for k in range(len(names))])
        draw.shuffle(rows)
        rate = RATE * (0.5 ** max(0, epoch - epochs // 2))
        for low in range(0, len(rows), BATCH):
            at = rows[low : low + BATCH]
            grads, _ = net.gradients(np.ascontiguousarray(data[at].T), target[at])
            step += 1
            for n, g in grads.items():
                g = np.clip(g, -1, 1)
                first[n] += 0.1 * (g - first[n])
                second[n] += 0.001 * (g * g - second[n])
                net.w[n] -= (rate * (first[n] / (1 - 0.9**step)) / (np.sqrt(second[n] / (1 - 0.999**step)) + 1e-8)).astype(np.float32)
    return net


def learn(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> Network | None:
    """A network from the labelled rows that are not held out."""
    rows = docs.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang"), remainder(id_col).alias("part"))
    known = rows.where((F.col("part") != HELD) & F.col("lang").isNotNull() & F.col("text").isNotNull()).withColumn("h", F.xxhash64("id", "text"))
    # rows of one id and text count once, so neither a hot id nor copies of a row swell or starve the sample
    counts = cut(known.groupBy("lang").agg(F.approx_count_distinct("h").alias("n")).withColumnRenamed("lang", "of"))
    languages = counts.count()
    quota = max(1, SAMPLE_DOCS * FULL_LANGUAGES // max(FULL_LANGUAGES, languages))
    u = F.shiftrightunsigned(F.xxhash64("h", F.lit(3)), 11).cast("double") / float(1 << 53)
    chosen = known.join(F.broadcast(counts) if languages <= 100_000 else counts, F.col("lang") == F.col("of")).where(u < (1.5 * quota + 16) / F.col("n"))
    room = F.greatest(F.length("text") - PIECE_CHARS, F.lit(0)) + 1
    pieces = F.array(*[F.substring(F.col("text"), (F.pmod(F.xxhash64("h", F.lit(k)), room) + 1).cast("int"), F.lit(PIECE_CHARS)) for k in range(PIECES)])
    rows = chosen.select("lang", "h", u.alias("u"), pieces.alias("pieces")).dropDuplicates(["lang", "h"]).collect()
    texts, labels, taken = [], [], {}
    for row in sorted(rows, key=lambda r: (r["u"], r["h"], r["lang"])):
        taken[row["lang"]] = taken.get(row["lang"], 0) + 1
        if taken[row["lang"]] <= quota:
            for piece in dict.fromkeys(row["pieces"]):
                texts.append(piece.encode("utf-8", "replace"))
                labels.append(row["lang"])
    return train(texts, labels)


def pooled(net: Network, texts: list[bytes], window: int = WINDOW, rows: int = ROWS) -> np.ndarray:
    """Mean probabilities over all positions of each text; texts are not empty."""
    sizes = np.array([len(t) for t in texts])
    rows = max(1, rows * FULL_LANGUAGES // max(FULL_LANGUAGES, len(net.labels)))
    counts = -(-sizes // window)
    owner = np.repeat(np.arange(len(texts)), counts)
    data = np.full((int(counts.sum()), window), 32, np.uint8)
    real = np.full(len(data), window)
    at = 0
    for text, size, n in zip(texts, sizes.tolist(), counts.tolist()):
        data[at : at + n].reshape(-1)[:size] = np.frombuffer(text, np.uint8)
        real[at + n - 1] = size - (n - 1) * window
        at += n
    sums = np.zeros((len(texts), len(net.labels)))
    for low in range(0, len(data), rows):
        p = net.positions(np.ascontiguousarray(data[low : low + rows].T))
        inside = np.arange(window)[:, None] < real[low : low + rows][None, :]
        np.add.at(sums, owner[low : low + rows], np.einsum("trk,tr->rk", p, inside.astype(np.float32)))
    return sums / sizes[:, None]


def verdict(net: Network | None, text_col: str = "text") -> Column:
    """A struct of lang_pred and score. Only texts go to Python, and only verdicts come back."""
    result = StructType([StructField("lang_pred", StringType()), StructField("score", DoubleType())])
    if net is None:
        return F.struct(F.lit("und").alias("lang_pred"), F.lit(0.0).alias("score"))

    def run(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in columns:
            lang, score = ["und"] * len(column), [0.0] * len(column)
            group: list[int] = []
            texts: list[bytes] = []
            size = 0
            for k, value in enumerate(column):
                if text := value.as_py():
                    group.append(k)
                    texts.append(text)
                    size += len(text)
                if group and (size >= WINDOW * ROWS or k == len(column) - 1):
                    p = pooled(net, texts)
                    for x, best, value in zip(group, p.argmax(1).tolist(), p.max(1).tolist()):
                        lang[x], score[x] = net.labels[best], min(1.0, value)
                    group, texts, size = [], [], 0
            yield pa.StructArray.from_arrays([pa.array(lang, pa.string()), pa.array(score, pa.float64())], ["lang_pred", "score"])

    return in_worker(run, result)(F.when(F.col(text_col).rlike(r"\p{L}"), F.col(text_col).cast("binary")))


def predict(docs: DataFrame, net: Network | None, text_col: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The keep columns, lang_pred and score."""
    name = free_name(docs, "found")
    return docs.select(*keep, verdict(net, text_col).alias(name)).select(*keep, f"{name}.lang_pred", f"{name}.score")


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """doc_id, held_out, lang_pred, score of every row, learned from the rows that are not held out."""
    net = learn(docs, id_col, text_col, lang_col)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(remainder(id_col) == HELD, F.lit(False)).alias("held_out"), F.col(text_col).alias("text"))
    return predict(rows, net, "text", ("doc_id", "held_out"))
