"""URL filter, web archives, mixing, language identification."""

import base64
import hashlib
import io
import random
from collections import defaultdict

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from strandmill.llm import language_id, mixture, queries, url_filter, web_archive


def fitting(url, rules, default="allow"):
    """Host, path, rule and verdict by trying every rule."""
    if url is None or "://" not in url:
        return "", "", None, default
    rest = url.split("://", 1)[1]
    end = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:end])
    tail = rest[end:]
    path = tail[: min([tail.find(c) for c in "?#" if c in tail], default=len(tail))]
    hits = [(len(h + p), len(h), h + p, v) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(hits, default=None)
    return host, path, best and best[2], best[3] if best else default


URLS = [
    None, "", "no scheme", "http://", "http://COM/", "http://com", "HTTP://A.Example.COM/en/x?q=1", "https://www.example.com/en/#t", "http://x.net/es/://y", "http://net/fr", "http://net/fr/", "http://notcom/", "a://b.com:80/",
    "http://u@www.example.com/en/", "http://..com/", "http://x.com?y/z", "http://é.com/ü/", "x://com/\n/en/",
]


@pytest.fixture
def urls(spark):
    return spark.createDataFrame([(k, u, "clash", "clash") for k, u in enumerate([*URLS, URLS[6]])], "page_id long, url string, rule string, host string")


def test_url_filter_equals_trying_every_rule(spark, urls):
    rules = queries.URL_RULES
    for judged in (url_filter.judge(urls, rules), url_filter.judge_by_join(urls, spark.createDataFrame(rules, "host string, path string, verdict string"))):
        rows = judged.collect()
        assert len(rows) == len(URLS) + 1
        for r in rows:
            assert (r["host"], r["path"], r["rule"], r["verdict"]) == fitting(r["url"], rules), r["url"]


def test_rules_of_many_path_lengths(spark):
    rules = [("a.com", "/" + "x" * k, "block" if k % 2 else "allow") for k in range(4300)]
    urls = spark.createDataFrame([(1, "http://a.com/" + "x" * 4299 + "/y"), (2, "http://b.a.com/xx?x"), (3, "http://a.org/"), (4, None), (5, "http://a.com")], "page_id long, url string")
    want = [(1, "a.com/" + "x" * 4299, "block"), (2, "a.com/xx", "allow"), (3, None, "allow"), (4, None, "allow"), (5, None, "allow")]
    joined = url_filter.judge_by_join(urls, spark.createDataFrame(rules, "host string, path string, verdict string"))
    for found in (url_filter.judge(urls, rules), joined):
        assert sorted((r["page_id"], r["rule"], r["verdict"]) for r in found.collect()) == want


def test_url_filter_with_many_rules(spark):
    draw = random.Random(4)
    part = lambda: draw.choice(["a", "b", "ab", "ba.a", "b.b"])
    rules = list({(part(), draw.choice(["", "/", "/a", "/a/b", "/b"])): draw.choice(["allow", "block"]) for _ in range(40)}.items())
    rules = [(h, p, v) for (h, p), v in rules]
    table = spark.createDataFrame([(k, f"x://{part()}.{part()}{draw.choice(['', '/', '/a', '/a/b/c', '/ba'])}") for k in range(200)], "page_id long, url string")
    for r in url_filter.judge(table, rules, default="block").collect():
        want = fitting(r["url"], rules, "block")
        assert (r["rule"], r["verdict"]) == want[2:], r["url"]


def test_digest_collisions_do_no_harm(tmp_path, monkeypatch):
    monkeypatch.setattr(url_filter.xxhash, "xxh64_intdigest", lambda data: len(data))
    (tmp_path / "rules").write_bytes(url_filter.pack_rules([("ab", "", "block"), ("ba", "", "allow"), ("cc", "", "block")]))
    array = url_filter.RuleArray(str(tmp_path / "rules"))
    found = array.find([b"ba", b"xx", b"cc", b"ab"])
    assert [array.string(k) if k >= 0 else None for k in found] == [b"ba", None, b"cc", b"ab"]


def test_url_filter_without_rows_or_rules(spark, urls):
    assert url_filter.judge(urls.limit(0), queries.URL_RULES).collect() == []
    assert {r["verdict"] for r in url_filter.judge(urls, []).collect()} == {"allow"}


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query_equals_its_twin(spark, sf, name):
    con = duckdb.connect()
    for table in ("pages", "documents", "benchmark"):
        con.execute(f"create view {table} as select * from '{sf}/{table}.parquet'")
    got = queries.queries()[name](spark, sf)
    want = con.execute(f"select {', '.join(got.columns)} from ({queries.oracle_sql()[name]})").fetchall()
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, want))


def test_archives_round_trip(spark, sf):
    pages = spark.read.parquet(f"{sf}/pages.parquet").select("page_id", "url", "html")
    extra = spark.createDataFrame([(10**6, None, None), (10**6 + 1, "http://a b/ü", ""), (10**6 + 2, "x", "é\r\n\r\nHTTP/1.1 200\n"), (10**6 + 3, "x", "y" * 300_000), (10**6 + 4, "x", "y" * 300_000), (10**6 + 5, "z", "y" * 300_000)], "page_id long, url string, html string")
    table = pages.union(extra)
    leader = {}
    rows = table.collect()
    for r in rows:
        leader[r["html"] or ""] = max(leader.get(r["html"] or "", -1), r["page_id"])
    want = sorted((r["page_id"], len((r["html"] or "").encode()), base64.b32encode(hashlib.sha1((r["html"] or "").encode()).digest()).decode(), *(("response", None) if leader[r["html"] or ""] == r["page_id"] else ("revisit", leader[r["html"] or ""]))) for r in rows)
    got = web_archive.round_trip(table).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()
    assert sorted(map(tuple, got)) == want


def test_arc_versions_and_declared_lengths():
    for version, fields in web_archive.ARC_FIELDS.items():
        block = b"HTTP/1.0 200 OK\r\nA: b\r\n\r\nbody\n\nmore"
        data = web_archive.arc_version_block(version, "f.arc") + web_archive.arc_record(version, "http://x/", "20200102030405", block) + web_archive.arc_record(version, "http://y/", "2020", b"bare")
        first, second = web_archive.read_arc(io.BytesIO(data))
        assert list(first.fields) == fields and first.block == block and second.block == b"bare"
        warc = web_archive.to_warc(first, "7")
        assert (warc.headers["WARC-Type"], warc.headers["WARC-Date"]) == ("response", "2020-01-02T03:04:05Z")
        assert warc.headers["WARC-Payload-Digest"] == "sha1:" + web_archive.sha1_base32(b"body\n\nmore")
        assert web_archive.to_warc(second).headers["WARC-Type"] == "resource" and web_archive.to_warc(second).headers["WARC-Date"] == "2020-01-01T00:00:00Z"
        assert web_archive.to_warc(first, "7").headers["WARC-Record-ID"] == warc.headers["WARC-Record-ID"]
        assert [r.block for r in web_archive.read_warc(io.BytesIO(web_archive.warc_bytes(warc) * 2))] == [block, block]
    with pytest.raises(ValueError):
        list(web_archive.read_arc(io.BytesIO(data[:-3])))


def test_revisits_refer_to_their_response(spark, tmp_path):
    rows = [(1, "http://a.com/x y", "same"), (2, "http://b.com/", "same"), (2, "http://b.com/", "same"), (3, None, None), (None, "http://c.com/", None), (4, "http://d.com/", "é" * 70_000)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumns({"sha": F.lit("own"), "leader": F.lit(1), "refers_to": F.lit(2)})
    folder = f"file://{tmp_path}/w"
    manifest = web_archive.archive_pages(pages, folder)
    found = {(r["page_id"], r["record_type"], r["refers_to"], r["payload_bytes"]) for r in web_archive.read_archives(spark, folder, manifest).collect()}
    assert found == {(1, "revisit", 2, 4), (2, "response", None, 4), (3, "response", None, 0), (None, "revisit", 3, 0), (4, "response", None, 140_000)}
    records = [x for r in manifest.collect() for x in web_archive.read_warc(open(r["path"], "rb"))]
    by_page = {x.headers.get("WARC-Page-Id"): x.headers for x in records}
    assert sum(x.headers["WARC-Type"] == "warcinfo" for x in records) == manifest.count() and len(records) == len(rows) + manifest.count()
    assert by_page["1"]["WARC-Refers-To"] == by_page["2"]["WARC-Record-ID"] and by_page["1"]["WARC-Refers-To-Target-URI"] == "http://b.com/" and by_page["1"]["WARC-Refers-To-Date"] == by_page["2"]["WARC-Date"]


def test_mix_beside_columns_of_its_own_names(spark):
    rows = [(k, "a b c", "s", "mine") for k in range(5)] + [(None, None, None, "mine"), (0, "a b c", "s", "mine")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, size string").withColumns({"bin": F.lit(1), "q": F.lit(1), "target": F.lit("x"), "u": F.lit(2)})
    got = mixture.mix(docs).collect()
    assert len(got) == 7 and all(r["size"] in (0, 3) for r in got) and {r["source_size"] for r in got} == {18, 0}


def test_archives_of_no_pages(spark):
    assert web_archive.round_trip(spark.createDataFrame([], "page_id long, url string, html string")).collect() == []


def brute_targets(sizes, cap=3.0):
    order = sorted(sizes, key=lambda s: (s is None, s))
    weight = {s: 1 + k % 3 for k, s in enumerate(order)}
    total, full = sum(sizes.values()), set()
    while True:
        rest = {s for s in order if s not in full}
        left = total - sum(cap * sizes[s] for s in full)
        share = {s: left * weight[s] / sum(weight[x] for x in rest) for s in rest}
        over = {s for s in rest if share[s] > cap * sizes[s]}
        if not over:
            return share | {s: cap * sizes[s] for s in full}
        full |= over


@pytest.mark.parametrize("skewed", [False, True])
def test_mix_targets_and_sizes(spark, sf, skewed):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text", "source")
    if skewed:
        docs = docs.withColumn("source", F.when(F.col("doc_id") % 3 == 0, "big").when(F.col("doc_id") < 5, "tiny").when(F.col("doc_id") % 7 == 0, None).otherwise(F.col("source")))
    docs = docs.union(spark.createDataFrame([(-1, None, "src0"), (-2, "", None), (-3, "a b", None), (-3, "a b", None)], "doc_id long, text string, source string"))
    rows = mixture.mix(docs).collect()
    own = {}
    by = defaultdict(list)
    for r in docs.collect():
        own.setdefault(r["doc_id"], r["source"])
    for r in rows:
        by[own[r["doc_id"]]].append(r)
    want = brute_targets({s: sum(r["size"] for r in part) for s, part in by.items()})
    for s, part in by.items():
        assert all(r["target"] == pytest.approx(want[s]) and r["source_size"] == sum(x["size"] for x in part) for r in part)
        assert all(r["taken"] == r["copies"] * r["size"] and 0 <= r["copies"] <= 3 for r in part)
        assert abs(sum(r["taken"] for r in part) - want[s]) <= max(r["size"] for r in part) / 2 + 1e-6
    assert sorted(map(tuple, rows)) == sorted(map(tuple, mixture.mix(docs).collect()))


def test_mix_is_pareto_order(spark):
    docs = spark.createDataFrame([(k, "w " * 10, f"s{k % 2}") for k in range(400)], "doc_id long, text string, source string")
    rows = {r["doc_id"]: r for r in mixture.mix(docs).collect()}
    u = {r["doc_id"]: r["u"] for r in docs.select("doc_id", ((F.shiftrightunsigned(F.xxhash64(F.col("doc_id").cast("string"), F.xxhash64("text"), F.lit(17)), 11).cast("double") + 0.5) / float(1 << 53)).alias("u")).collect()}
    for s in (0, 1):
        part = sorted((k for k in rows if k % 2 == s), key=u.get)
        copies = [rows[k]["copies"] for k in part]
        assert copies == sorted(copies, reverse=True)


def test_mix_follows_document_weights(spark):
    docs = spark.createDataFrame([(k, "w " * 10, "s", float(k % 2)) for k in range(200)], "doc_id long, text string, source string, weight double")
    rows = mixture.mix(docs, weight_col="weight").collect()
    assert all(r["copies"] == (2 if r["doc_id"] % 2 else 0) for r in rows)


def test_mix_of_no_rows(spark):
    assert mixture.mix(spark.createDataFrame([], "doc_id long, text string, source string")).collect() == []


def test_language_held_out_accuracy(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = language_id.identify(docs).join(docs.select("doc_id", "lang", F.length("text").alias("n")), "doc_id").where("held_out and n >= 60").collect()
    assert sum(r["lang_pred"] == r["lang"] for r in rows) >= 0.95 * len(rows)


def test_language_edges(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text", "lang")
    net = language_id.learn(docs)
    odd = spark.createDataFrame([(1, None), (2, ""), (3, "123 !? \n"), (4, "the " * 20_000), (4, "the"), (None, "\ud7ff é")], "doc_id long, text string").withColumn("score", F.lit("clash"))
    got = language_id.predict(odd, net).collect()
    assert [(r["lang_pred"], r["score"]) for r in got[:3]] == [("und", 0.0)] * 3
    assert len(got) == 6 and all(0 < r["score"] <= 1 and r["lang_pred"] in net.labels for r in got[3:])
    assert {r["lang_pred"] for r in language_id.identify(docs.withColumn("lang", F.lit(None).cast("string"))).collect()} == {"und"}


def test_gradients_equal_differences():
    draw = np.random.default_rng(1)
    net = language_id.Network.fresh(["a", "b", "c"], 4)
    net.w = {k: v.astype(np.float64) for k, v in net.w.items()}
    data, label = draw.integers(97, 101, (6, 5)).astype(np.uint8), draw.integers(0, 3, 5)
    grads, _ = net.gradients(data, label)
    for name in net.w:
        flat = net.w[name].reshape(-1)
        rows = [97 * 12 + 3, 99 * 12 + 7, 100 * 12 + 11] if name.startswith("in") else range(0, flat.size, max(1, flat.size // 4))
        for k in rows:
            before, e = flat[k], 5e-3
            flat[k] = before + e
            up = net.gradients(data, label)[1]
            flat[k] = before - e
            down = net.gradients(data, label)[1]
            flat[k] = before
            assert grads[name].reshape(-1)[k] == pytest.approx((up - down) / (2 * e), abs=2e-4), name


def test_every_position_is_labelled_and_pooled():
    net = language_id.Network.fresh(["a", "b"], 4)
    text = bytes(range(32, 120)) * 5
    p = language_id.pooled(net, [text, text[:1]], window=64, rows=3)
    sums = sum(net.positions(np.frombuffer(text[k : k + 64].ljust(64), np.uint8)[:, None])[: len(text[k : k + 64]), 0].sum(0) for k in range(0, len(text), 64))
    assert np.allclose(p[0], sums / len(text), atol=1e-5) and np.allclose(p.sum(1), 1, atol=1e-5)
