"""Items of the library tables with their recounted token lengths."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.functions.tokens import proxy_tokens
from quire.plans.session import cut_lineage, read_table


def _key(*cols: str) -> F.Column:
    return F.concat_ws("::", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in cols])


def paragraph_lengths(paragraphs: DataFrame) -> DataFrame:
    """book_id, paragraph_index, n: recounted from the text; repeated rows fall together (largest count)."""
    return paragraphs.select("book_id", "paragraph_index", proxy_tokens(F.col("text")).alias("n")).groupBy("book_id", "paragraph_index").agg(F.max("n").alias("n"))


def scene_members(scenes: DataFrame) -> DataFrame:
    """One row for each distinct (scene, paragraph); repeated scenes count once, a null or empty list gives none."""
    return (
        scenes.select("book_id", "chapter_index", "scene_index", F.explode("paragraphs").alias("p"))
        .select("book_id", "chapter_index", "scene_index", F.col("p.paragraph_index").alias("paragraph_index"), F.col("p.n_tokens").alias("declared"))
        .groupBy("book_id", "chapter_index", "scene_index", "paragraph_index")
        .agg(F.max("declared").alias("declared"))
    )


def scene_lengths(scenes: DataFrame, by: DataFrame) -> DataFrame:
    """book_id, chapter_index, scene_index, n: sum of the recounted paragraphs (by: book_id, paragraph_index, n), without separators.

    A paragraph that the paragraphs table lacks counts as declared in the scene, else 0.
    """
    return (
        scene_members(scenes)
        .join(by, ["book_id", "paragraph_index"], "left")
        .groupBy("book_id", "chapter_index", "scene_index")
        .agg(F.sum(F.coalesce("n", "declared", F.lit(0))).cast("int").alias("n"))
    )


def chunk_lengths(chunks: DataFrame) -> DataFrame:
    """id, n: recounted from the text; repeated rows fall together."""
    return chunks.select("id", proxy_tokens(F.col("text")).alias("n")).groupBy("id").agg(F.max("n").alias("n"))


def all_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """item_level, item_key, n over paragraphs, scenes and chunks."""
    paragraphs, scenes, chunks = (read_table(spark, sf_dir, t) for t in ("paragraphs", "scenes", "chunks"))
    lengths = cut_lineage(paragraph_lengths(paragraphs))  # priced once for both levels
    p = lengths.select(F.lit("paragraph").alias("item_level"), _key("book_id", "paragraph_index").alias("item_key"), "n")
    s = scene_lengths(scenes, lengths).select(F.lit("scene").alias("item_level"), _key("book_id", "chapter_index", "scene_index").alias("item_key"), "n")
    c = chunk_lengths(chunks).select(F.lit("chunk").alias("item_level"), F.coalesce("id", F.lit("")).alias("item_key"), "n")
    return p.unionByName(s).unionByName(c)


def budget_of(spark: SparkSession, sf_dir: str, task: str) -> dict[str, tuple[int, int, int]]:
    """item_level -> (capacity, overlap, sep_tokens) of one task; budgets is a fixed table of a few rows."""
    rows = read_table(spark, sf_dir, "budgets").where(F.lower(F.trim("task")) == task).collect()
    return {r["item_level"].strip().lower(): (int(r["capacity"]), int(r["overlap"] or 0), int(r["sep_tokens"] or 0)) for r in rows if r["item_level"] and r["capacity"]}
