"""Collocations, lexical search, toxicity and nearest neighbours against plain Python; the registered queries' columns."""

import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from strandmill.llm import collocations, lexical_search, queries, toxicity, vector_search
from strandmill.llm.perfect_hash import PerfectHash
from strandmill.llm.words import word_slices


def lowered(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def pieces(text):
    out, piece = [], ""
    for c in lowered(text) + "\n":
        if c in ".,;:!?\n\x0b\x0c\r":
            out.append([w for w in piece.replace("\t", " ").split(" ") if w])
            piece = ""
        else:
            piece += c
    return out


def plain_collocations(rows, least, longest=5, top=2000):
    f, n = defaultdict(Counter), Counter()
    for text, lang in rows:
        lang = lang or "und"
        for words in pieces(text or ""):
            n[lang] += len(words)
            for k in range(1, longest + 1):
                for i in range(len(words) - k + 1):
                    f[lang][tuple(words[i : i + k])] += 1
    out = []
    for lang, own in f.items():
        candidates = {p: a for p, a in own.items() if len(p) >= 2 and a >= least}
        kept = []
        for p, a in candidates.items():
            if any(len(q) > len(p) and 100 * b >= 100 * a and any(q[i : i + len(p)] == p for i in range(len(q))) for q, b in candidates.items()):
                continue
            score, k = min((1000 * a * n[lang] // (own[p[:k]] * own[p[k:]]), k) for k in range(1, len(p)))
            kept.append((-score, -a, " ".join(p).encode(), own[p[:k]], own[p[k:]]))
        out += [(lang, rank, p.decode(), -a, left, right, n[lang], -score) for rank, (score, a, p, left, right) in enumerate(sorted(kept)[:top], 1)]
    return sorted(out)


EDGE = [
    (None, "en"), ("", None), (" \t.,;", "en"), ("A b A b A b\tA b", None), ("é É é É x.y é É", "fr"), ("\x00 \x00 \x1c a\x0bb\x0cc\rd", "fr"), ("w " * 400, "de"), ("one two three. " * 60, "en"), ("one two. three four", "en"),
]


def run_mine(spark, rows, least):
    docs = spark.createDataFrame(rows, "text string, lang string").withColumns({c: F.lit("clash") for c in ("word", "n", "slot", "part", "own", "key", "total")})
    return sorted(tuple(r) for r in collocations.mine(docs, least=least).collect())


@pytest.mark.parametrize("least", [3, 20])
def test_collocations_equal_plain_python(spark, monkeypatch, least):
    monkeypatch.setattr(collocations, "PART", 40)
    monkeypatch.setattr(collocations, "GROUP", 2)
    monkeypatch.setattr(collocations, "WORDS", 30)
    draw = random.Random(least)
    words = [*"abcdefgh", "É", "the", "of"]
    rows = EDGE + [(" ".join(draw.choice(words) + draw.choice(["", "", "", ".", ",", "\t"]) for _ in range(draw.randrange(60))), draw.choice(["en", "en", None])) for _ in range(60)]
    want = plain_collocations(rows, least)
    assert run_mine(spark, rows, least) == want and len(want) > 5


def test_collocations_without_frequent_words(spark):
    assert run_mine(spark, [("a b c", "en"), (None, None)], 5) == []
    assert run_mine(spark, [], 5) == []
    assert run_mine(spark, [("a. a. a. a. a. a.", "en")], 5) == []


def test_collocation_arithmetic_is_exact(spark, monkeypatch):
    """Counts whose product passes 64 bits."""
    a, left, right, total = 3_000_000_000, 3_000_000_001, 3_000_000_007, 900_000_000_000_003
    none = F.array().cast("array<long>")
    long = lambda *v: F.array(*[F.lit(x) for x in v]).cast("array<long>")
    word = spark.range(1).select(F.lit(0).cast("long").alias("slot"), F.lit("en").alias("lang"), F.array(F.lit("x").cast("binary")).alias("words"), F.lit(left).alias("n"), none.alias("starts"), none.alias("ends"), F.lit(None).cast("long").alias("within"))
    pair = spark.range(1).select(F.lit(0).cast("long").alias("slot"), F.lit("en").alias("lang"), F.array(F.lit("x").cast("binary"), F.lit("y").cast("binary")).alias("words"), F.lit(a).alias("n"), long(left).alias("starts"), long(right).alias("ends"), F.lit(None).cast("long").alias("within"))
    totals = spark.createDataFrame([("en", total)], "lang string, total long")
    monkeypatch.setattr(collocations, "phrases", lambda *x: ([word, pair], totals))
    row = collocations.mine(spark.createDataFrame([], "text string, lang string")).head()
    assert row["score"] == 1000 * a * total // (left * right) and 1000 * a * total > 1 << 64


def test_perfect_hash_is_minimal_and_knows_its_keys():
    draw = np.random.default_rng(1)
    for n in (0, 1, 2, 63, 64, 65, 5000):
        keys = np.unique(draw.integers(0, 1 << 63, n, dtype=np.uint64))
        table = PerfectHash.from_bytes(PerfectHash.build(keys).to_bytes())
        assert sorted(table.find(keys).tolist()) == list(range(len(keys)))
        other = np.setdiff1d(draw.integers(0, 1 << 63, 2000, dtype=np.uint64), keys)
        assert (table.find(other) == -1).all()


def test_kept_neighbours_hold_all_longer_phrases():
    draw = np.random.default_rng(2)
    for _ in range(200):
        numbers = np.append(draw.integers(-1, 4, int(draw.integers(0, 30))), -1).astype(np.int32)
        left = collocations.neighbours(numbers)
        assert sorted(collocations.pairs_of(left)[1].tolist()) == sorted(collocations.pairs_of(numbers)[1].tolist())
        assert not len(left) or left[-1] == -1


def terms(text):
    out, word = [], ""
    for c in lowered(text or "") + " ":
        if ord(c) > 127 or c.isascii() and c.isalnum():
            word += c
        elif word:
            out.append(word)
            word = ""
    return out


def plain_search(docs, items, k=20):
    own = [(i, Counter(terms(t))) for i, t in docs]
    full = [(i, c, c.total()) for i, c in own if c]
    n_docs, n_terms = len(full), sum(n for *_, n in full)
    df = Counter(t for _, c, _ in full for t in c)
    weight = {t: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * d + 1))) for t, d in df.items()}
    out = []
    for item, text in dict.fromkeys(items):
        asked = Counter(terms(text))
        scored = []
        for i, c, n in full:
            m = 100 - 25 + (25 * n * n_docs) // n_terms
            score = sum(r * weight[t] * ((1_000_000_000 * c[t]) // (1000 * c[t] + 12 * m)) for t, r in asked.items() if t in c)
            if score > 0:
                scored.append((-score, i is None, i or 0))
        out += [(item, rank, None if none else i, -s) for rank, (s, none, i) in enumerate(sorted(scored)[:k], 1)]
    return sorted(out, key=str)


def run_search(spark, docs, items, k=20):
    d = spark.createDataFrame(docs, "doc_id long, text string").withColumns({c: F.lit("clash") for c in ("term", "block", "score", "query", "rank")})
    i = spark.createDataFrame(items, "item_id long, text string").withColumns({c: F.lit("clash") for c in ("term", "doc_id", "weight")})
    return sorted((tuple(r) for r in lexical_search.search(d, i, k).collect()), key=str)


def odd_documents(draw):
    words = [*"abcdefghijklmnopqrstuvwxyz", "é", "É", "naïve", "42"]
    docs = [(k, " ".join(draw.choices(words, k=draw.randrange(1, 40)))) for k in range(120)]
    docs += [(500 + k, docs[3][1]) for k in range(40)]  # copies tie
    docs += [(None, docs[3][1]), (None, None), (700, ""), (701, "..."), (9, "z z z z Z"), (9, "z z z z Z"), (1 << 60, "q-q_q"), (800, "a " * 30_000)]
    return docs


def test_search_equals_plain_python(spark):
    draw = random.Random(7)
    docs = odd_documents(draw)
    items = [(k, " ".join(draw.choices([*"abcdefghijklmnopqrstuvwxyzA", "é", "unseen"], k=draw.randrange(1, 12)))) for k in range(25)]
    items += [(1, "other text z"), (50, None), (51, ""), (52, "unseen words"), (53, "Z"), (53, "Z"), (None, "q"), (54, docs[3][1])]
    assert run_search(spark, docs, items) == plain_search(docs, items)
    assert run_search(spark, docs, items, 3) == plain_search(docs, items, 3)


def test_search_in_small_blocks_of_queries_and_all_terms(spark, monkeypatch):
    draw = random.Random(8)
    docs, items = odd_documents(draw), [(k, " ".join(draw.choices("abcdefghij", k=6))) for k in range(12)]
    monkeypatch.setattr(lexical_search, "QUERY_PAIRS", 15)
    monkeypatch.setattr(lexical_search, "TERMS", 3)
    assert run_search(spark, docs, items, 5) == plain_search(docs, items, 5)


def test_search_of_no_rows(spark):
    assert run_search(spark, [], [(1, "a")]) == [] == run_search(spark, [(1, "a b")], [])
    assert run_search(spark, [(1, None)], [(1, "a")]) == []


def test_words_of_long_texts_are_whole():
    text = ("ab Cd-é " * 500).encode() + b"x" * 3000 + b" end"
    assert [w for part in word_slices(text, 100) for w in part] == [w.encode() for w in terms(text.decode())]


def labelled(spark, n=900, seed=4):
    draw = random.Random(seed)
    mean = {"en": ["idiot", "scum", "moron"], "de": ["lowei", "lowest"]}
    rows = []
    for k in range(n):
        lang, toxic = draw.choice(["en", "de"]), int(draw.random() < 0.3)
        own = [draw.choice(["th", "an", "ing"] if lang == "en" else ["sch", "ung", "ei"]) + draw.choice(["er", "en", "at", "ou"]) for _ in range(draw.randrange(20, 80))]
        if toxic:
            for _ in range(3):
                own.insert(draw.randrange(len(own)), draw.choice(mean[lang]) + draw.choice(["", "s", "en"]))
        rows.append((k, " ".join(own), lang, "s", toxic))
    return rows


def test_toxicity_of_held_out_rows(spark):
    rows = labelled(spark)
    docs = spark.createDataFrame([r[:4] for r in rows], "doc_id long, text string, lang string, source string").withColumns({c: F.lit(1) for c in ("y", "h", "of", "part", "n", "id")})
    labels = spark.createDataFrame([(r[0], r[4]) for r in rows], "doc_id long, toxic int").withColumn("lang", F.lit("clash"))
    found = toxicity.detect(docs, labels)
    assert found.columns == ["doc_id", "held_out", "score", "predicted"]
    got = {r["doc_id"]: r for r in found.collect()}
    assert len(got) == len(rows)
    assert all(got[r[0]]["held_out"] == (zlib.crc32(str(r[0]).encode()) % 4 == 2) for r in rows)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in got.values())
    held = [(got[r[0]]["predicted"], r[4]) for r in rows if got[r[0]]["held_out"]]
    assert sum(p == y for p, y in held) >= 0.97 * len(held)
    again = {r["doc_id"]: r["score"] for r in toxicity.detect(docs, labels).collect()}
    assert again == {k: r["score"] for k, r in got.items()}


def test_toxicity_edges(spark):
    rows = labelled(spark, 300)
    labels = spark.createDataFrame([(r[0], r[4]) for r in rows] + [(rows[0][0], 1 - rows[0][4]), (None, 1), (5000, None)], "doc_id long, toxic int")
    odd = [(None, "idiot idiot", "en"), (900, None, None), (901, "", "en"), (902, "...", "en"), (903, "the " * 200_000 + "idiot idiots idioten", None), (904, "the " * 200_000, None), (904, "the " * 200_000, None), (905, "x" * 500_000, "en")]
    docs = spark.createDataFrame([r[:3] for r in rows] + odd, "doc_id long, text string, lang string")
    got = [r for r in toxicity.detect(docs, labels).collect() if r["doc_id"] is None or r["doc_id"] >= 900]
    assert len(got) == len(odd) and not [r for r in got if r["doc_id"] is None][0]["held_out"]
    score = {r["doc_id"]: r["score"] for r in got}
    assert score[900] == score[901] == score[902] < 0.3 and score[903] > score[904]
    none = toxicity.detect(docs, labels.where("toxic = 0")).select("score", "predicted").distinct().collect()
    assert [tuple(r) for r in none] == [(0.0, 0)]
    assert toxicity.detect(docs.limit(0), labels).collect() == []
    assert toxicity.detect(docs, labels.limit(0)).count() == docs.count()


def test_slices_of_a_text_score_as_the_whole(monkeypatch):
    rows = labelled(None, 200)
    net = toxicity.calibrated([r[1].encode() for r in rows], [r[2] for r in rows], np.array([r[4] for r in rows]), np.arange(len(rows)) % 4 == 0)
    texts = [r[1].encode() for r in rows[:30]] + [b"", b"idiot"]
    whole = toxicity.Reader(net).read(texts)
    monkeypatch.setattr(toxicity, "sliced", lambda text, reach, size=40, f=toxicity.sliced: f(text, reach, size))
    monkeypatch.setattr(toxicity, "SLICE", 50)
    monkeypatch.setattr(toxicity, "REMEMBERED", 40)
    cut = toxicity.Reader(net).read(texts)
    assert np.allclose(whole[0], cut[0], atol=1e-4) and (whole[1][:30] == cut[1][:30]).all()
    same = toxicity.Classifier.from_bytes(net.to_bytes(), net.languages.shape[1])
    assert np.array_equal(toxicity.Reader(same).read(texts)[0], whole[0])


def neighbours(spark, vectors, asked, k=20, **more):
    rows = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "vec_id long, embedding array<double>")
    found = defaultdict(list)
    for r in vector_search.search(rows, rows.where(F.col("vec_id").isin(asked)), k, **more).orderBy("query_id", "rank").collect():
        found[r["query_id"]].append((r["vec_id"], r["score"]))
    return found


def recall(found, vectors, asked, k=20):
    want = dict(vector_search.brute_force(np.arange(len(vectors)), vectors, asked, vectors[asked], k))
    return np.mean([len(set(want[q]) & {v for v, _ in found[q]}) / len(want[q]) for q in asked])


@pytest.mark.parametrize("kind", ["one long", "lengths of a hundred", "gaussian 64", "heavy tail"])
def test_recall_on_any_lengths(spark, kind):
    draw = np.random.default_rng(3)
    v = draw.normal(size=(4000, 64 if kind == "gaussian 64" else 16))
    if kind == "one long":
        v[17] *= 10_000
    if kind == "lengths of a hundred":
        v *= 10 ** draw.uniform(-2, 2, (len(v), 1))
    if kind == "heavy tail":
        v *= np.abs(draw.standard_cauchy((len(v), 1)))
    asked = list(range(0, 4000, 50))
    assert recall(neighbours(spark, v, asked), v, asked) >= 0.95


@pytest.mark.parametrize("scale", [1e200, 1e-200, 1e300, 5e-300])
def test_finite_vectors_of_any_size_are_found(spark, scale):
    v = np.random.default_rng(5).normal(size=(1500, 8)) * scale
    found = neighbours(spark, v, [0, 50, 100])
    assert all(len(found[q]) == 20 and q not in dict(found[q]) for q in (0, 50, 100))
    graph = vector_search.Graph.build(np.arange(1500), v)
    assert len(vector_search.best_of(graph, np.array([50]), np.array([0]), v[50:51], 20)) == 20


def test_ties_go_to_the_smaller_ids(spark):
    v = np.zeros((60, 4))
    v[:, 0] = 1.0
    v[:, 1] = np.arange(60)[::-1] / 7
    q = np.array([[1.0, 0, 0, 0]])
    found = neighbours(spark, np.vstack([v, q]), [60])
    assert found[60] == [(k, 1.0) for k in range(20)]
    graph = vector_search.Graph.build(np.arange(60), v)
    assert vector_search.best_of(graph, np.array([60]), np.array([0]), q, 20)["vec_id"].tolist() == list(range(20))
    many = np.vstack([np.hstack([np.ones((3000, 1)), np.random.default_rng(1).normal(size=(3000, 3))]), q])
    assert all(s == 1.0 for _, s in neighbours(spark, many, [3000])[3000])


COLUMNS = {
    "op2_license_scans": [("doc_id", "bigint"), ("n_words", "bigint"), ("n_base", "bigint"), ("first_word", "bigint"), ("last_word", "bigint"), ("base_labels", "string"), ("labels", "string"), ("score", "double")],
    "op4_secret_scans": [("doc_id", "bigint"), ("n_assign", "bigint"), ("n_access", "bigint"), ("n_hex", "bigint"), ("base_sha256", "string"), ("spans", "string")],
    "op5_quality_rules": [("doc_id", "bigint"), ("n_words", "bigint"), ("word_chars", "bigint"), ("n_symbols", "bigint"), ("n_dup_lines", "bigint"), ("n_repeat_words", "bigint"), ("base_failed", "boolean"), ("kept", "boolean")],
    "op6_language_id": [("doc_id", "bigint"), ("held_out", "boolean"), ("lang_pred", "string"), ("score", "double")],
    "op9_nearest_neighbours": [("query_id", "bigint"), ("rank", "int"), ("vec_id", "bigint"), ("score", "double")],
    "op10_mixing": [("doc_id", "bigint"), ("size", "bigint"), ("source_size", "bigint"), ("target", "double"), ("taken", "bigint")],
    "op11_collocations": [("lang", "string"), ("rank", "bigint"), ("phrase", "string"), ("a", "bigint"), ("l", "bigint"), ("r", "bigint"), ("n", "bigint"), ("score", "bigint")],
    "op12_toxicity": [("doc_id", "bigint"), ("held_out", "boolean"), ("score", "double"), ("predicted", "int")],
    "op13_lexical_search": [("item_id", "bigint"), ("rank", "int"), ("doc_id", "bigint"), ("score", "bigint")],
}


@pytest.mark.parametrize("name", sorted(COLUMNS))
def test_registered_queries_have_the_contract_columns(spark, sf, name):
    found = queries.queries()[name](spark, sf)
    assert set(COLUMNS[name]) <= set(found.dtypes)
    if name not in ("op9_nearest_neighbours", "op11_collocations", "op13_lexical_search"):
        assert found.count() == spark.read.parquet(f"{sf}/documents.parquet").count()
