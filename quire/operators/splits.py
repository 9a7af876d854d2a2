"""Stable hash splits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def stable_unit(c: Column) -> Column:
    """A number in [0, 1) that only depends on the string."""
    return F.conv(F.substring(F.sha1(c.cast("string")), 1, 12), 16, 10).cast("bigint").cast("double") / F.lit(float(16**12))


def choose_val_books(books: DataFrame, fraction: float = 0.1, named: list[str] | None = None) -> DataFrame:
    """book_id of the validation books: the named ones in any case, else the lowest units; a lone book never.

    The lowest n of N come from a distributed top-n, n rounded half to even.
    """
    b = books.select("book_id").where("book_id is not null").distinct()
    if named:
        low = sorted({n.lower() for n in named})
        wanted = books.sparkSession.createDataFrame([(n,) for n in low], "low string")
        found = b.withColumn("low", F.lower("book_id")).join(F.broadcast(wanted), "low", "left_semi").select("book_id")
        known = {r["book_id"].lower() for r in found.collect()}  # at most the names given
        if set(low) - known:
            raise ValueError(f"unknown validation books: {sorted(set(low) - known)}")
        return found
    total = b.count()
    n = min(max(1, round(total * fraction)), total - 1) if fraction > 0 and total else 0
    return b.withColumn("u", stable_unit(F.col("book_id"))).orderBy("u", "book_id").limit(max(0, n)).select("book_id")


def assign_splits(chunks: DataFrame, mode: str = "book", fraction: float = 0.1, val_books: DataFrame | None = None) -> DataFrame:
    """chunks with split 'train' or 'val': by book membership, by the unit of book and first chapter, or none."""
    if mode == "none" or fraction <= 0 and val_books is None:
        return chunks.withColumn("split", F.lit("train"))
    if mode == "chapter":
        u = stable_unit(F.concat_ws("::", "book_id", F.col("chapter_index").cast("string")))
        return chunks.withColumn("split", F.when(u < fraction, "val").otherwise("train"))
    if mode != "book":
        raise ValueError(f"unknown split mode {mode!r}")
    val = (val_books if val_books is not None else choose_val_books(chunks, fraction)).select("book_id", F.lit(True).alias("_val"))
    return chunks.join(val, "book_id", "left").select(*chunks.columns, F.when(F.col("_val"), "val").otherwise("train").alias("split"))
