"""Invariants of a build, each as a relation of violations, and one pass that fails on any."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def over_budget(chunks: DataFrame, budget: int) -> DataFrame:
    """Chunks dearer than the budget."""
    return chunks.where(F.col("n_tokens") > budget).select("id", "n_tokens")


def covered_paragraphs(chunks: DataFrame) -> DataFrame:
    """id, book_id, paragraph_index of every paragraph a chunk holds, its gaps left out."""
    span = F.when((F.col("paragraph_index_start") >= 0) & (F.col("paragraph_index_end") >= F.col("paragraph_index_start")), F.sequence("paragraph_index_start", "paragraph_index_end")).otherwise(F.array().cast("array<int>"))
    held = F.array_except(span, F.coalesce("paragraph_index_gaps", F.array().cast("array<int>")))
    return chunks.select("id", "book_id", F.explode(held).alias("paragraph_index"))


def repeated_paragraphs(chunks: DataFrame) -> DataFrame:
    """Paragraphs that stand in two chunks of a book."""
    return covered_paragraphs(chunks).groupBy("book_id", "paragraph_index").agg(F.countDistinct("id").alias("n_chunks")).where("n_chunks > 1")


def out_of_order(chunks: DataFrame) -> DataFrame:
    """Chunks that start before the one they follow; the predecessor is met by its number, so a book of any size stays spread."""
    c = chunks.select("id", "book_id", "order_in_book", "paragraph_index_start").distinct()
    before = c.select("book_id", (F.col("order_in_book") + 1).alias("order_in_book"), F.col("paragraph_index_start").alias("start_before"))
    return c.join(before, ["book_id", "order_in_book"]).where("paragraph_index_start < start_before").select("id", "book_id", "order_in_book")


def repeated_sources(chunks: DataFrame) -> DataFrame:
    """Chunks that name a source file twice."""
    return chunks.where(F.size(F.array_distinct("source_files")) < F.size("source_files")).select("id", "source_files")


def index_gaps(paragraphs: DataFrame) -> DataFrame:
    """book_id, paragraph_index missing between the first and last paragraph of a book."""
    seen = paragraphs.select("book_id", "paragraph_index").where("book_id is not null and paragraph_index is not null").distinct()
    # the next index of each is met by a window over ranges of indices, the ranges' ends by their first rows
    seg = F.floor(F.col("paragraph_index") / 4096)
    s = seen.withColumn("seg", seg)
    inner = s.withColumn("next", F.lead("paragraph_index").over(W.partitionBy("book_id", "seg").orderBy("paragraph_index")))
    firsts = s.groupBy("book_id", "seg").agg(F.min("paragraph_index").alias("first"))
    after = firsts.withColumn("after", F.lead("first").over(W.partitionBy("book_id").orderBy("seg"))).select("book_id", "seg", "after")
    gaps = inner.join(after, ["book_id", "seg"]).withColumn("to", F.coalesce("next", "after")).where("to > paragraph_index + 1")
    return gaps.select("book_id", F.explode(F.sequence(F.col("paragraph_index") + 1, F.col("to") - 1)).alias("paragraph_index"))


def verify(chunks: DataFrame, budget: int) -> None:
    """Raise on the first broken invariant."""
    for what, bad in (("over budget", over_budget(chunks, budget)), ("paragraph in two chunks", repeated_paragraphs(chunks)), ("out of order", out_of_order(chunks))):
        if rows := bad.limit(3).collect():
            raise AssertionError(f"{what}: {rows}")
