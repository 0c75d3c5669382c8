"""Jaccard join, vector search, SentencePiece, pipeline."""

import random
from pathlib import Path

import numpy as np
import pytest
import regex
import sentencepiece
from pyspark import SparkFiles
from pyspark.sql import functions as F

import corpus_pipeline
from strandmill.llm import components, language_id, mixture, near_join, piece_lattice, secret_scan, vector_search
from strandmill.llm.unit_table import Units, segments


def shingles(text):
    words = (text or "").encode().split()
    return {tuple(words[k : k + 5]) for k in range(len(words) - 4)} if len(words) >= 5 else {tuple(words)} if words else set()


def brute_classes(rows):
    sets = [shingles(t) for _, t in rows]
    root, links = list(range(len(rows))), [0] * len(rows)

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j]:
                common = len(sets[i] & sets[j])
                if common >= 0.8 * (len(sets[i]) + len(sets[j]) - common):
                    links[i] += 1
                    links[j] += 1
                    root[find(i)] = find(j)
    least = {}
    for k in range(len(rows)):
        least[find(k)] = min(least.get(find(k), 10**9), rows[k][0])
    return sorted((rows[k][0], least[find(k)] if sets[k] else rows[k][0], links[k]) for k in range(len(rows)))


def near_rows(seed, n=60):
    draw = random.Random(seed)
    words = [f"w{k}" for k in range(400)]
    base = [draw.choices(words, k=120) for _ in range(3)]
    rows = []
    for k in range(n):
        text = list(draw.choice(base))
        for _ in range(draw.randrange(0, 5)):
            text[draw.randrange(len(text))] = draw.choice(words)
        rows.append((k, " ".join(text)))
    return rows + [(100, None), (101, ""), (102, " \n"), (103, "one two"), (104, "one  two\n"), (105, "two one"), (106, " ".join(words) * 30), (107, " ".join(words) * 30), (107, " ".join(words) * 30)]


@pytest.mark.parametrize("block", [1024, 7])
def test_jaccard_join_equals_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(near_join, "BLOCK", block)
    rows = near_rows(3)
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("key", F.lit("clash"))
    assert sorted(tuple(r) for r in near_join.join(df).collect()) == brute_classes(rows)


def test_keep_one_of_each_class(spark):
    rows = near_rows(5, 20)
    kept = near_join.keep_one(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted({c for _, c, _ in brute_classes(rows)})


@pytest.mark.parametrize("ids", ["null", "repeated"])
def test_keep_one_loses_no_class_to_its_ids(spark, ids):
    rows = near_rows(5, 20)
    name = {"null": lambda k: None, "repeated": lambda k: k % 3}[ids]
    classes = {}
    for k, (_, c, _) in enumerate(brute_classes([(k, t) for k, (_, t) in enumerate(rows)])):
        classes.setdefault(c, []).append(rows[k][1])
    kept = near_join.keep_one(spark.createDataFrame([(name(k), t) for k, (_, t) in enumerate(rows)], "doc_id long, text string")).collect()
    assert len(kept) == len(classes)
    for members in classes.values():
        assert sum(r["text"] in members for r in kept) == (1 if (members[0] or "").split() else sum(not (r["text"] or "").split() and r["text"] in members for r in kept)) >= 1


def test_keep_one_of_a_clean_text_under_a_copied_id(spark):
    a, b = (" ".join(f"{x}{k}" for k in range(40)) for x in "ab")
    rows = [(5, a), (5, b), (6, a), (7, a), (None, " "), (None, " ")]
    kept = near_join.keep_one(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted(map(tuple, kept.collect()), key=str) == sorted([(5, a), (5, b), (None, " "), (None, " ")], key=str)


def test_join_of_no_rows(spark):
    assert near_join.join(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_bands_reach_the_recall():
    bands, rows = near_join.choose_bands()
    assert 1 - (1 - 0.8**rows) ** bands >= 0.9999 and bands * rows <= near_join.MAX_HASHES


def test_search_recall_and_scores(spark, sf):
    table = spark.read.parquet(f"{sf}/embeddings.parquet")
    rows = table.toPandas()
    ids, x = rows["vec_id"].to_numpy(), np.stack(rows["embedding"]).astype(float)
    asked = ids % 20 == 0
    got = vector_search.search(table, table.where("vec_id % 20 = 0"), shard_rows=150).toPandas()
    want = dict(vector_search.brute_force(ids, x, ids[asked], x[asked], 20))
    place = {v: k for k, v in enumerate(ids)}
    hits = 0
    for q, part in got.groupby("query_id"):
        part = part.sort_values("rank")
        assert part["rank"].tolist() == list(range(1, 21)) and q not in set(part["vec_id"])
        assert np.allclose(part["score"], [x[place[v]] @ x[place[q]] for v in part["vec_id"]])
        assert part[["score", "vec_id"]].apply(lambda r: (-r["score"], r["vec_id"]), axis=1).is_monotonic_increasing
        hits += len(set(part["vec_id"]) & set(want[q]))
    assert got["query_id"].nunique() == asked.sum() and hits >= 0.95 * 20 * asked.sum()


def test_search_edges(spark):
    rows = [(0, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [1.0, 0.0]), (3, [0.5, 0.5]), (4, None), (5, [0.0, 0.0]), (6, [float("nan"), 1.0]), (7, [float("inf"), 1.0]), (8, [None, 1.0]), (9, [1.0, 2.0, 3.0]), (10, []), (None, [1.0, 1.0]), (20, [2.0, 0.0])]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = vector_search.search(table, table.where("vec_id % 20 = 0"), 3).orderBy("query_id", "rank").collect()
    assert [(r["query_id"], r["vec_id"], r["score"]) for r in got] == [(0, 20, 2.0), (0, 1, 1.0), (0, 2, 1.0), (20, 0, 2.0), (20, 1, 2.0), (20, 2, 2.0)]
    assert vector_search.search(table.limit(0), table.limit(0)).collect() == []


def test_search_of_repeated_rows(spark):
    rows = [(0, [1.0, 0.0]), (0, [1.0, 0.0]), (1, [3.0, 0.0]), (2, [2.0, 1.0]), (2, [2.0, 1.0]), (3, [1.0, 5.0]), (20, [0.0, 1.0]), (20, [1.0, 0.0])]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("query", F.lit("clash")).withColumn("v", F.lit(1)).withColumn("rank", F.lit(0))
    got = [(r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in vector_search.search(table, table.where("vec_id % 20 = 0"), 3).collect()]
    assert sorted(x for x in got if x[0] == 0) == [(0, 1, 1, 3.0), (0, 2, 2, 2.0), (0, 3, 2, 2.0)]
    assert sorted(x for x in got if x[0] == 20) == sorted([(20, 1, 3, 5.0), (20, 2, 2, 1.0), (20, 3, 2, 1.0), (20, 1, 1, 3.0), (20, 2, 2, 2.0), (20, 3, 2, 2.0)])


def test_join_of_the_larger_table_equals_all_pairs(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    want = set(brute_classes([(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]))
    got = {tuple(r) for r in near_join.join(docs).select("doc_id", "class_id", "n_links").collect()}
    assert sum(n for _, _, n in want) > 100 and got == want


def test_hubs_of_components(spark):
    rows = [(k, 0) for k in range(1, 900)] + [(900 + k, 901 + k) for k in range(40)] + [(5, 5)]
    got = {r["node"]: r["root"] for r in components.connected(spark.createDataFrame(rows, "u long, v long")).collect()}
    assert got == {k: 0 for k in range(900)} | {k: 900 for k in range(900, 941)}
    assert components.connected(spark.createDataFrame([], "u long, v long")).collect() == []


def test_large_components_are_verified_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(near_join, "BLOCK", 8)
    draw = random.Random(5)
    base = [f"w{draw.randrange(10**6)}" for _ in range(60)]
    rows = [(k, " ".join(draw.choice(base) if draw.random() < 0.01 else w for w in base)) for k in range(70)]
    got = {(r["doc_id"], r["class_id"], r["n_links"]) for r in near_join.join(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == set(brute_classes(rows))


def test_graph_survives_its_bytes():
    draw = np.random.default_rng(2)
    graph = vector_search.Graph.build(np.arange(500), draw.normal(size=(500, 8)))
    again = vector_search.Graph.from_bytes(graph.to_bytes())
    q = draw.normal(size=(10, 8))
    assert (graph.search(q) == again.search(q)).all()


TEXTS = [
    None, "", " ", "x", "Hello  world\nfoo é ﬁ 123 ", "x" * 300 + "ab" * 400, "a\tb\r\n  </s> <unk> ².² 日本語 👩\u200d💻 e\u0301", "    if x:\n\t\treturn (a->b) // c['d']", "word " * 3000, "Hello  world\nfoo é ﬁ 123 ",
]


@pytest.mark.parametrize("most", [10**9, 20, 0])
def test_encoding_equals_the_library(spark, sf, most):
    model = sentencepiece.SentencePieceProcessor(model_file=piece_lattice.MODEL)
    vocabulary = piece_lattice.Vocabulary.load()
    odd = spark.createDataFrame([(-k, t) for k, t in enumerate(TEXTS)], "doc_id long, text string")
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").limit(60).union(odd).withColumn("unit", F.lit("clash"))
    rows = piece_lattice.encode(docs, vocabulary, keep=("doc_id", "text"), most=most)
    for r in rows.collect():
        if r["text"] is None:
            assert r["ids"] is None and r["round_trip"] is None
        else:
            assert r["ids"] == model.encode(r["text"]) and r["round_trip"], r["doc_id"]
    back = piece_lattice.decode(rows.where("doc_id <= 0"), vocabulary, keep=("doc_id",))
    assert {r["doc_id"]: r["text"] for r in back.collect()} == {-k: t for k, t in enumerate(TEXTS)} | {r["doc_id"]: r["text"] for r in rows.where("doc_id = 0").collect()}


def test_lattice_of_every_unit_merges_as_the_heap_does(spark):
    vocabulary = piece_lattice.Vocabulary.load()
    draw = random.Random(7)
    words = sorted({piece_lattice.MARK * draw.randrange(3) + "".join(draw.choices("theringaosédł", k=draw.randrange(1, 20))) for _ in range(150)})
    edged = piece_lattice.lattice(spark.createDataFrame([(w,) for w in words], "unit string"), vocabulary)
    got = {r["unit"]: r["ids"] for r in piece_lattice.with_ids(edged, vocabulary).collect()}
    assert got == {w: vocabulary.encode_unit(w) for w in words}


def test_unigram_fold_is_the_best_path(spark):
    draw = random.Random(9)
    pieces = sorted({"".join(draw.choices("abc", k=draw.randrange(1, 4))) for _ in range(20)} | {"a", "b"})
    vocabulary = piece_lattice.Vocabulary([(p, 10 + k, -draw.random() * 5) for k, p in enumerate(pieces)], {}, 0, "unigram")
    words = sorted({"".join(draw.choices("abcz", k=draw.randrange(1, 12))) for _ in range(60)})
    edged = piece_lattice.lattice(spark.createDataFrame([(w,) for w in words], "unit string"), vocabulary)
    score = {i: s for _, i, s in vocabulary.pieces} | {0: vocabulary.floor}
    for r in piece_lattice.with_ids(edged, vocabulary).collect():
        best = {0: 0.0}
        w = r["unit"]
        for end in range(1, len(w) + 1):
            best[end] = max(best[s] + (vocabulary.by_text[w[s:end]][1] if w[s:end] in vocabulary.by_text else vocabulary.floor if end - s == 1 else -1e9) for s in range(end))
        assert sum(score[i] for i in r["ids"]) == pytest.approx(best[len(w)]), w


def test_shipped_units_are_found(spark):
    vocabulary = piece_lattice.Vocabulary.load()
    docs = spark.createDataFrame([(1, "the cat the cat sat on the mat, the mat 7 7\n")] * 3, "doc_id long, text string")
    words = piece_lattice.dictionary(docs, vocabulary)
    table = piece_lattice.UnitTable(Path(SparkFiles.get(n)).read_bytes() for n in piece_lattice.ship(words, vocabulary))
    found = {r["unit"]: r["ids"] for r in words.collect()}
    assert len(found) >= 5 and len(table.digest) == len(found)
    for unit, ids in found.items():
        (at,) = table.find(Units([unit.replace(piece_lattice.MARK, " ")], True))
        assert table.ids[table.id_at[at] : table.id_at[at] + table.id_n[at]].tolist() == ids == vocabulary.encode_unit(unit)


def test_units_are_those_of_the_patterns():
    mark = piece_lattice.MARK
    fine = rf"{mark}*\p{{L}}+|{mark}*[^{mark}\p{{L}}0-9\n]+|{mark}+|[0-9]|\n"
    coarse = rf"{mark}*[^{mark}]+|{mark}+"
    texts = [t for t in TEXTS if t] + [mark + " a" + mark + "b  c", "\n\n12a "]
    for pattern, is_fine in ((fine, True), (coarse, False)):
        units = Units([" " + t for t in texts], is_fine)
        assert [units.unit(k) for k in range(len(units.size))] == [u for t in texts for u in regex.findall(pattern, mark + t.replace(" ", mark))]
        assert units.bounds.tolist() == np.cumsum([0] + [len(regex.findall(pattern, mark + t.replace(" ", mark))) for t in texts]).tolist()
        whole = Units([" " + "ab cd  e12\n f" * 50], is_fine)
        parts = Units(list(segments("ab cd  e12\n f" * 50, 20)), is_fine)
        assert len(parts.bounds) > 10 and parts.string == whole.string and parts.start.tolist() == whole.start.tolist()


def test_equal_digests_are_told_apart(monkeypatch):
    monkeypatch.setattr(Units, "digests", lambda self: np.full(len(self.size), 7, np.uint64))
    table = piece_lattice.UnitTable([piece_lattice.UnitTable.pack(["ab", "cd", "efg"], [[1], [2, 3], [4]], False)])
    found = table.find(Units(["cd", "ab", "xy", "efg", "efgh"], False))
    assert [table.ids[table.id_at[k] : table.id_at[k] + table.id_n[k]].tolist() if k >= 0 else None for k in found] == [None, [1], None, None, None]


def test_encoding_of_no_rows(spark):
    assert piece_lattice.encode(spark.createDataFrame([], "doc_id long, text string"), piece_lattice.Vocabulary.load()).collect() == []


def test_pipeline_stages_equal_brute_force(spark, sf, tmp_path):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "ngram_jaccard_join", "secret_scans", "mixing", "sentencepiece"]
    rows, measure = {}, secret_scan.Novelty(*secret_scan.identifiers())
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, sf)
        if k < 4:
            assert sorted(out.columns) == sorted(docs.columns)
        out.write.parquet(str(tmp_path / name))
        before, docs = docs, spark.read.parquet(str(tmp_path / name))
        a, rows[name] = before.toPandas(), docs.toPandas()
        if name == "language_id":
            lettered = a[a["text"].str.contains(r"[^\W\d_]", regex=True)]
            assert len(rows[name]) >= 0.95 * len(lettered)
        if name == "ngram_jaccard_join":
            assert sorted(rows[name]["doc_id"]) == sorted({c for _, c, _ in brute_classes(list(zip(a["doc_id"], a["text"])))})
        if name == "secret_scans":
            assert len(a) == len(rows[name]) and not any(secret_scan.scan_text(t, measure) for t in rows[name]["text"])
            assert (rows[name]["n_chars"] == rows[name]["text"].str.len()).all()
        if name == "mixing":
            copies = {r["doc_id"]: r["copies"] for r in mixture.mix(before).collect()}
            assert rows[name]["doc_id"].value_counts().to_dict() == {i: c for i, c in copies.items() if c}
    model = sentencepiece.SentencePieceProcessor(model_file=piece_lattice.MODEL)
    text = dict(zip(rows["mixing"]["doc_id"], rows["mixing"]["text"]))
    assert len(rows["sentencepiece"]) == len(rows["mixing"])
    assert all(list(i) == model.encode(text[d]) for d, i in zip(rows["sentencepiece"]["doc_id"], rows["sentencepiece"]["ids"]))


def test_pipeline_stages_keep_columns_of_any_name(spark):
    base = "the quick brown fox jumps over the lazy dog and runs home again "
    rows = [(k, f"{base * 3} tail{k} secret = 'abcdefghijkl{k}'", "en", "a", 5) for k in range(4)]
    names = ["score", "lang_pred", "copies", "size", "target", "row", "copy", "found", "__text", "__gate", "spans", "key", "root", "first", "band", "n", "words", "u", "q", "bin", "count", "__lang", "__r0", "__k0", "r0", "k0", "worded", "of", "h", "id", "part"]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").withColumns({n: F.lit(f"own {n}") for n in names})
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, "")
        docs = spark.createDataFrame(docs.collect(), docs.schema)
        assert docs.columns[5:] == names and docs.count(), name
        assert all(r[n] == f"own {n}" for r in docs.collect() for n in names), name
    assert corpus_pipeline.STAGES[-1][1](spark, docs, "").count() == docs.count()


def test_pipeline_of_odd_documents(spark):
    base = "the quick brown fox jumps over the lazy dog and runs home again " * 3
    rows = [(k, base + f" tail{k}", "en", "a", 5) for k in range(8)] + [(50, None, None, None, None), (51, "", "en", "a", 0), (52, "12 34", "de", "b", 5), (53, 'secret = "abcdefghijklmnop" ' + base, None, None, 9), (0, base + " tail0", "en", "a", 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    assert language_id.learn(docs).labels == ["en"]
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, "")
        docs = spark.createDataFrame(docs.collect(), docs.schema)
        if name == "ngram_jaccard_join":
            ids = sorted(r["doc_id"] for r in docs.collect())
            assert ids.count(0) == 1 and not {50, 51, 52} & set(ids)
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long"), "").count() == 0, name
