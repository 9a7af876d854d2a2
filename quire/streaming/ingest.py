"""Structured streams of documents: priced and classified as they arrive, counted in windows of event time."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.functions.tokens import proxy_tokens, word_count


def read_documents(spark: SparkSession, path: str, schema: str, files_per_trigger: int = 16) -> DataFrame:
    """New Parquet files of a folder as a stream; the schema is given, never inferred."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(path)


def price(docs: DataFrame, text: str = "text") -> DataFrame:
    """docs with n_words and n_tokens; stateless, so the same for batches and streams."""
    return docs.withColumn("n_words", word_count(F.col(text))).withColumn("n_tokens", proxy_tokens(F.col(text)))


def windowed_totals(docs: DataFrame, time: str, length: str = "1 day", late: str = "2 days") -> DataFrame:
    """Documents and tokens by event-time window and source; rows later than the watermark are dropped from the state."""
    w = F.window(F.col(time).cast("timestamp"), length)
    return docs.withColumn(time, F.col(time).cast("timestamp")).withWatermark(time, late).groupBy(w.alias("w"), "source").agg(F.count("*").alias("n_docs"), F.sum("n_tokens").alias("n_tokens")).select(F.col("w.start").alias("window_start"), "source", "n_docs", "n_tokens")
