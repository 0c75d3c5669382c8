"""Streams of new samples: candidates into a partitioned table, and cohort counts that follow them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from strandmill import schema
from strandmill.operators.filters import signal_sizes


def candidate_stream(spark: SparkSession, folder: str, files_per_trigger: int = 100) -> DataFrame:
    """Candidates of sample files (Parquet) as they come; sample is the file's folder."""
    columns = schema.CANDIDATE + ", sample string, seen timestamp"
    return spark.readStream.schema(columns).option("maxFilesPerTrigger", files_per_trigger).parquet(folder)


def append_filtered(stream: DataFrame, table: str, checkpoint: str, least: int = 40, most: int = 10_000_000) -> StreamingQuery:
    """Appends candidates of allowed sizes to a table by sv_type; each file is taken once."""
    return signal_sizes(stream, least, most).writeStream.format("parquet").partitionBy("sv_type").option("path", table).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()


def arrival_counts(stream: DataFrame, late: str = "1 hour", window: str = "10 minutes") -> DataFrame:
    """Candidates per type and time window; rows later than `late` are left out."""
    return stream.withWatermark("seen", late).groupBy(F.window("seen", window), "sv_type").agg(F.count(F.lit(1)).alias("n"), F.approx_count_distinct("sample").alias("samples"))
