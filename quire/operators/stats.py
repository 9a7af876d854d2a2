"""Corpus statistics as small relations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quire.functions.tokens import word_count

PERCENTILES = (5, 25, 50, 75, 95)


def length_summary(df: DataFrame, value: str = "n_tokens") -> DataFrame:
    """One row: n, min, max, mean, p05 to p95 by the rank rounded half to even; nulls are left out.

    Ranks come from the histogram of lengths, one row a length, whatever the number of rows.
    """
    h = df.where(F.col(value).isNotNull()).groupBy(F.col(value).alias("v")).agg(F.count("*").alias("k"))
    cum = h.withColumn("upto", F.sum("k").over(W.orderBy("v"))).withColumn("n", F.sum("k").over(W.partitionBy()))

    def at(p: int) -> Column:
        rank = F.rint(F.lit(p / 100.0) * (F.col("n") - 1).cast("double"))
        return F.min(F.when(F.col("upto") > rank, F.col("v"))).alias(f"p{p:02d}")

    return cum.agg(F.coalesce(F.max("n"), F.lit(0)).alias("n"), F.min("v").alias("min"), F.max("v").alias("max"), F.round(F.sum(F.col("v") * F.col("k")) / F.max("n"), 1).alias("mean"), *[at(p) for p in PERCENTILES])


def book_stats(paragraphs: DataFrame) -> DataFrame:
    """book_id with its chapters, scenes, paragraphs, words, tokens; repeated rows count once."""
    from quire.functions.tokens import proxy_tokens

    one = paragraphs.groupBy("book_id", "paragraph_index").agg(F.max("chapter_index").alias("c"), F.max("scene_index").alias("s"), F.max(word_count(F.col("text"))).alias("w"), F.max(proxy_tokens(F.col("text"))).alias("t"))
    return one.groupBy("book_id").agg(
        F.countDistinct("c").alias("n_chapters"), F.countDistinct("c", "s").alias("n_scenes"), F.count("*").alias("n_paragraphs"), F.sum("w").alias("n_words"), F.sum("t").alias("n_tokens")
    )


def chunk_totals(chunks: DataFrame, budget: int, boundary: int = 2) -> DataFrame:
    """One row of totals: chunks, tokens, utilisation, boundary health."""
    n = F.count("*")
    flag = lambda name: F.count_if(F.col(f"flags.{name}"))
    share = lambda c: F.when(n > 0, F.round(100.0 * c / n, 2)).otherwise(0.0)
    tokens = F.coalesce(F.sum("n_tokens"), F.lit(0))
    return chunks.agg(
        n.alias("n_chunks"), tokens.alias("content_tokens"), (n * boundary).alias("boundary_tokens"), (tokens + n * boundary).alias("total_tokens"),
        F.when(n > 0, F.round(tokens / (n * float(budget)), 4)).otherwise(0.0).alias("utilisation"),
        flag("starts_chapter").alias("starts_chapter"), flag("starts_scene").alias("starts_scene"), flag("ends_scene").alias("ends_scene"), flag("continues_scene").alias("continues_scene"),
        share(flag("ends_scene")).alias("ends_scene_pct"), share(F.count_if(F.col("flags.starts_chapter") | F.col("flags.starts_scene"))).alias("opens_at_boundary_pct"),
    )


def split_totals(chunks: DataFrame) -> DataFrame:
    """split, chunks, tokens."""
    return chunks.groupBy("split").agg(F.count("*").alias("n_chunks"), F.coalesce(F.sum("n_tokens"), F.lit(0)).alias("n_tokens"))


def oversize_by_kind(oversize: DataFrame) -> DataFrame:
    """kind with its rows, tokens and a histogram of actions."""
    per = oversize.groupBy("kind", "action").agg(F.count("*").alias("k"), F.sum("n_tokens").alias("t"))
    return per.groupBy("kind").agg(F.sum("k").alias("n"), F.sum("t").alias("n_tokens"), F.map_from_entries(F.array_sort(F.collect_list(F.struct("action", "k")))).alias("actions"))


def excluded_fraction(chunks: DataFrame, oversize: DataFrame) -> DataFrame:
    """One row: excluded_tokens, content_tokens, fraction to six places."""
    x = oversize.where("action = 'excluded'").agg(F.coalesce(F.sum("n_tokens"), F.lit(0)).alias("excluded_tokens"))
    c = chunks.agg(F.coalesce(F.sum("n_tokens"), F.lit(0)).alias("content_tokens"))
    both = x.join(c)  # one row each
    total = F.col("excluded_tokens") + F.col("content_tokens")
    return both.withColumn("fraction", F.when(total > 0, F.round(F.col("excluded_tokens") / total, 6)).otherwise(0.0))
