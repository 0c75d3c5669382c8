"""Corpus pipeline: language ID, near-duplicate removal, secret scan, mixing, tokenisation.

STAGES lists (name, function); each function takes (spark, docs, sf_dir) and returns the next docs.
All but the last return the columns of documents, and any others that docs has, whatever their names.
run() applies them to documents, each stage's rows written as Parquet to the shared folder and read again.

Defined results: a null or blank text, or one without a letter, is rejected by the first stage; null and
repeated ids, null sources and languages are ordinary rows of every stage; an empty table stays empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandmill.llm import language_id, mixture, near_join, piece_lattice, secret_scan
from strandmill.llm.shared import fresh_path, free_name

#: A document stays if its predicted language is its labelled one or this sure, and it has a language.
SURE = 0.5
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def keep_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents without a recognised language ("und") and those recognised with a probability under SURE.
    A kept document's null language becomes the predicted one."""
    name = free_name(docs, "found")
    found = docs.withColumn(name, language_id.verdict(language_id.learn(docs)))
    kept = found.where((F.col(f"{name}.lang_pred") != "und") & (F.col(f"{name}.score") >= SURE))
    return kept.withColumn("lang", F.coalesce("lang", f"{name}.lang_pred")).select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class stays, the one of the smallest id."""
    return near_join.keep_one(docs)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced in the text; n_chars follows. Every document stays."""
    clean = secret_scan.redact(docs)
    return clean.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    rows = docs.select("doc_id", "source", "text", F.struct(*docs.columns).alias("row"))
    mixed = mixture.mix(rows, keep=("row",)).where("copies > 0")
    return mixed.select("row", F.explode(F.array_repeat(F.lit(1), F.col("copies").cast("int"))).alias("copy")).select("row.*")


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, source, ids of the pieces and whether decoding gives the text."""
    return piece_lattice.encode(docs, piece_lattice.Vocabulary.load(), keep=("doc_id", "source"))


STAGES = [
    ("language_id", keep_languages),
    ("ngram_jaccard_join", drop_near_duplicates),
    ("secret_scans", redact_secrets),
    ("mixing", mix_sources),
    ("sentencepiece", encode_pieces),
]

#: The recurrent network, compression and sampling by hash have no SQL form; tests/llm compares run() to brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = fresh_path(spark, "pipeline")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs.write.parquet(f"{folder}/{k}-{name}")
            docs = spark.read.parquet(f"{folder}/{k}-{name}")
    return docs
