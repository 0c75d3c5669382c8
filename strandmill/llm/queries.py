"""The registered queries of the training-data operators and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandmill.llm import collocations, language_id, lexical_search, license_scan, mixture, near_join, piece_lattice, quality_rules, secret_scan, toxicity, url_filter, vector_search, web_archive

#: The contract's rules.
URL_RULES = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"), ("net", "/es/", "block"), ("net", "/fr/", "block")]


def op1_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url")
    return url_filter.judge(pages, URL_RULES).select("page_id", "host", "path", "rule", "verdict")


def op2_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def op3_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    encoded = piece_lattice.encode(spark.read.parquet(f"{sf_dir}/documents.parquet"), piece_lattice.Vocabulary.load())
    return encoded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids", "round_trip")


def op4_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.digest(secret_scan.scan(spark.read.parquet(f"{sf_dir}/documents.parquet")))


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def op7_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_join.join(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    back = web_archive.round_trip(spark.read.parquet(f"{sf_dir}/pages.parquet"))
    return back.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op9_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return vector_search.search(vectors, vectors.where("vec_id % 20 = 0"))


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixture.mix(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.mine(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def op12_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.detect(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search.search(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    registered = (
        op1_url_filters, op2_license_scans, op3_sentencepiece, op4_secret_scans, op5_quality_rules, op6_language_id, op7_ngram_jaccard_join,
        op8_warc, op9_nearest_neighbours, op10_mixing, op11_collocations, op12_toxicity, op13_lexical_search,
    )
    return {f.__name__: f for f in registered}


OP1_SQL = r"""
WITH u AS (
  SELECT page_id,
    translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path
  FROM pages),
r(h, p, v) AS (VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'), ('net', '/es/', 'block'), ('net', '/fr/', 'block')),
best AS (
  SELECT u.page_id, u.host, u.path, arg_max(r.h || r.p, length(r.h || r.p)) AS rule, arg_max(r.v, length(r.h || r.p)) AS v
  FROM u LEFT JOIN r ON (u.host = r.h OR u.host LIKE '%.' || r.h) AND starts_with(u.path, r.p)
  GROUP BY u.page_id, u.host, u.path)
SELECT page_id, host, path, rule, coalesce(v, 'allow') AS verdict FROM best
"""


#: Base 32 of SHA-1: 160 bits as text, five at a time.
OP8_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages), d AS (SELECT page_id, strlen(h) AS payload_bytes, sha1(h) AS s FROM p),
b AS (SELECT *, array_to_string(list_transform(range(1, 41), lambda i: substr('0000000100100011010001010110011110001001101010111100110111101111', 4 * (strpos('0123456789abcdef', substr(s, i, 1)) - 1) + 1, 4)), '') AS bits FROM d),
n AS (SELECT *, max(page_id) OVER (PARTITION BY s) AS leader,
  array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + CAST(16 * CAST(substr(bits, 5 * i + 1, 1) AS INT) + 8 * CAST(substr(bits, 5 * i + 2, 1) AS INT) + 4 * CAST(substr(bits, 5 * i + 3, 1) AS INT) + 2 * CAST(substr(bits, 5 * i + 4, 1) AS INT) + CAST(substr(bits, 5 * i + 5, 1) AS INT) AS INT), 1)), '') AS payload_digest
  FROM b)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN leader = page_id THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN leader = page_id THEN NULL ELSE leader END AS refers_to FROM n
"""


OP11_SQL = r"""
WITH p AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents WHERE text IS NOT NULL),
w AS (SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda x: x <> '') AS ws FROM p),
g AS (SELECT lang, k, unnest(list_transform(range(1, len(ws) - k + 2), lambda i: array_to_string(ws[i : i + k - 1], ' '))) AS phrase FROM w, range(1, 6) AS r(k) WHERE len(ws) >= k),
c AS (SELECT lang, k, phrase, count(*) AS a FROM g GROUP BY ALL),
n AS (SELECT lang, CAST(sum(a) AS BIGINT) AS n FROM c WHERE k = 1 GROUP BY lang),
cand AS (SELECT lang, k, phrase, a, string_split(phrase, ' ') AS ws FROM c WHERE k >= 2 AND a >= 100),
cuts AS (
  SELECT d.lang, d.phrase, d.a, n.n, j, x.a AS l, y.a AS r, CAST((1000::HUGEINT * d.a * n.n) // (x.a::HUGEINT * y.a) AS BIGINT) AS score
  FROM cand d JOIN n USING (lang), range(1, 5) AS o(j), c AS x, c AS y
  WHERE j < d.k AND x.lang = d.lang AND x.phrase = array_to_string(d.ws[1 : j], ' ') AND y.lang = d.lang AND y.phrase = array_to_string(d.ws[j + 1 : d.k], ' ')),
best AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1),
kept AS (
  SELECT * FROM best b WHERE NOT EXISTS (
    SELECT 1 FROM cand e WHERE e.lang = b.lang AND len(e.phrase) > len(b.phrase) AND contains(' ' || e.phrase || ' ', ' ' || b.phrase || ' ') AND 100 * e.a >= 100 * b.a)),
ranked AS (SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score FROM kept)
SELECT * FROM ranked WHERE rank <= 2000
"""


OP13_SQL = r"""
WITH t AS (
  SELECT d, doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM (SELECT row_number() OVER () AS d, doc_id, text FROM documents)),
f AS (SELECT d, doc_id, term, count(*) AS tf FROM t GROUP BY ALL),
s AS (SELECT d, CAST(sum(tf) AS BIGINT) AS n FROM f GROUP BY d),
a AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS terms FROM s),
w AS (SELECT term, CAST(floor(1000 * ln((2.0 * docs + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM f, a GROUP BY term, docs),
i AS (
  SELECT q, item_id, term, count(*) AS repeats FROM (
    SELECT q, item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
    FROM (SELECT row_number() OVER () AS q, item_id, text FROM (SELECT DISTINCT item_id, text FROM benchmark))) GROUP BY ALL),
r AS (
  SELECT q, item_id, d, doc_id, CAST(sum(repeats * w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * docs) // terms)))) AS BIGINT) AS score
  FROM i JOIN w USING (term) JOIN f USING (term) JOIN s USING (d), a GROUP BY ALL),
o AS (SELECT *, CAST(row_number() OVER (PARTITION BY q ORDER BY score DESC, doc_id NULLS LAST) AS INTEGER) AS rank FROM r WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM o WHERE rank <= 20
"""


def oracle_sql() -> dict[str, str]:
    return {"op1_url_filters": OP1_SQL, "op8_warc": OP8_SQL, "op11_collocations": OP11_SQL, "op13_lexical_search": OP13_SQL}
