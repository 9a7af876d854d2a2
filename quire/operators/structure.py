"""Lines to blocks, and blocks to the hierarchy of chapters, scenes and paragraphs.

Order is always an explicit column. Null texts are empty paragraphs and vanish; repeated rows of a key count once.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quire.functions import pytext
from quire.functions import text as X
from quire.operators.running import SEGMENT, running


def text_lines(docs: DataFrame, key: str, text: str = "text") -> DataFrame:
    """key, line_ord, line of every line, line ends normalised."""
    return docs.select(key, F.posexplode(F.split(X.normalise_newlines(F.col(text)), "\n")).alias("line_ord", "line"))


def text_blocks(docs: DataFrame, key: str, text: str = "text", aggressive: bool = False, numbered: bool = False, strip_pages: bool = False) -> DataFrame:
    """key, block_ord, kind, text, level of plain or Markdown texts.

    A text is one row and its blocks depend on nothing else, so batches are read where they lie: no line is ever
    shuffled. A null text has no blocks.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows, blocks = [], []
            for i, t in enumerate(b.column(1).to_pylist()):
                if t is not None:
                    found = pytext.text_blocks(t, aggressive, numbered, strip_pages)
                    rows += [i] * len(found)
                    blocks += [(n, *x) for n, x in enumerate(found)]
            columns = zip(*blocks) if blocks else ((), (), (), ())
            arrays = [pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.string(), pa.string(), pa.int32()))]
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(rows, pa.int64())), *arrays], names=[key, "block_ord", "kind", "text", "level"])

    kept = docs.select(key, text)
    schema = T.StructType([kept.schema[0], *(T.StructField(n, t) for n, t in (("block_ord", T.LongType()), ("kind", T.StringType()), ("text", T.StringType()), ("level", T.IntegerType())))])
    return kept.mapInArrow(run, schema)


def drop_running_heads(blocks: DataFrame, titles: DataFrame) -> DataFrame:
    """Blocks without headings that repeat the book's title or name page furniture; titles: book_id, title."""
    named = titles.groupBy("book_id").agg(F.max("title").alias("_title"))
    kept = blocks.join(named, "book_id", "left")
    key = X.heading_key(F.col("text"))
    bad = (F.col("kind") == "heading") & (F.coalesce(key == X.heading_key(F.coalesce("_title", F.lit(""))), F.lit(False)) | key.isin(X.FURNITURE))
    return kept.where(~F.coalesce(bad, F.lit(False))).drop("_title")


def require_unique(blocks: DataFrame) -> None:
    """Raise where two blocks of a book have one order number: one of them would be lost."""
    twice = blocks.groupBy("book_id", "block_ord").count().where("count > 1").select("book_id", "block_ord").limit(3).collect()
    if twice:
        raise AssertionError(f"blocks with one order number: {[tuple(r) for r in twice]}")


#: Rows of a book up to which its windows run in one task.
WHOLE = 500_000


def hierarchy(blocks: DataFrame, segmented: bool | None = None) -> DataFrame:
    """book_id, chapter_index, scene_index, block_ord, kind ('chapter_heading', 'scene_heading', 'paragraph'), text, paragraph_index.

    A heading of level 1 opens a chapter only after prose since the last one; a scene opens at a chapter's first
    content, at a heading after a paragraph, and at a paragraph that a separator parts from the one before.
    Both forms give the same rows: windows over whole books share one shuffle and one sort; once any book has more
    than WHOLE rows (segmented: None looks), windows over segments spread it over many tasks.
    """
    if segmented is None:
        most = blocks.groupBy("book_id").count().agg(F.max("count")).first()[0]
        segmented = (most or 0) > WHOLE
    keyed = blocks.where("book_id is not null and block_ord is not null").select("book_id", "block_ord", "kind", "text", "level")
    # by book from the start: the windows need no other shuffle, nor another sort
    one = (keyed if segmented else keyed.repartition("book_id")).groupBy("book_id", "block_ord").agg(F.max_by(F.struct("kind", "text", "level"), F.struct("kind", F.coalesce("text", F.lit("")))).alias("b"))
    b = one.select("book_id", "block_ord", "b.kind", F.coalesce("b.text", F.lit("")).alias("text"), F.coalesce("b.level", F.lit(0)).alias("level"))
    b = b.where("kind <> 'paragraph' or trim(text) <> ''").withColumn("seg", F.floor(F.col("block_ord") / SEGMENT))
    return _by_segments(b) if segmented else _by_books(b)


def _by_books(b: DataFrame) -> DataFrame:
    is_p, is_h = F.col("kind") == "paragraph", F.col("kind") == "heading"
    top = is_h & (F.col("level") <= 1)
    w = W.partitionBy("book_id").orderBy("block_ord")
    upto, earlier = w.rowsBetween(W.unboundedPreceding, 0), w.rowsBetween(W.unboundedPreceding, -1)
    b = b.withColumn("paras", F.sum(is_p.cast("int")).over(upto))
    b = b.withColumn("opens", top & (F.col("paras") > F.coalesce(F.max(F.when(top, F.col("paras"))).over(earlier), F.lit(0))))
    b = b.withColumn("chapter", F.sum(F.col("opens").cast("int")).over(upto)).withColumn("broke", F.max(F.when(F.col("kind") == "scene_break", F.col("block_ord"))).over(upto))
    content = is_p | (is_h & (F.col("level") > 1))
    q = F.last(F.when(content, F.struct("block_ord", "kind", "chapter")), ignorenulls=True).over(earlier)
    b = b.where("kind <> 'scene_break'").withColumn("q", q)
    first = F.col("q").isNull() | (F.col("q.chapter") != F.col("chapter"))
    new = content & (first | (is_h & (F.col("q.kind") == "paragraph")) | (is_p & (F.col("q.kind") == "paragraph") & F.coalesce(F.col("broke") > F.col("q.block_ord"), F.lit(False))))
    named = top & (F.trim("text") != "")
    c = W.partitionBy("book_id", "chapter")
    b = b.withColumn("new", new.cast("int")).withColumn("alive", F.max((content | named).cast("int")).over(c)).where("alive = 1")
    b = b.withColumn("scene", F.sum("new").over(c.orderBy("block_ord").rowsBetween(W.unboundedPreceding, 0)) - 1)
    dense = F.dense_rank().over(W.partitionBy("book_id").orderBy("chapter")) - 1
    return b.select(
        "book_id", dense.cast("int").alias("chapter_index"), F.when(~top, F.col("scene")).cast("int").alias("scene_index"), "block_ord",
        F.when(top, "chapter_heading").when(is_p, "paragraph").otherwise("scene_heading").alias("kind"), "text", F.when(is_p, F.col("paras") - 1).cast("int").alias("paragraph_index"),
    )


def _by_segments(b: DataFrame) -> DataFrame:
    is_p = F.col("kind") == "paragraph"
    top = (F.col("kind") == "heading") & (F.col("level") <= 1)
    counted = running(b, ["book_id"], ["block_ord"], "seg", paras=("sum", is_p.cast("int")))
    # each top heading and the one before it
    earlier = running(counted.where(top), ["book_id"], ["block_ord"], "seg", rank=("sum", F.lit(1)))
    prior = earlier.select(F.col("book_id").alias("pb"), (F.col("rank") + 1).alias("pr"), F.col("paras").alias("before"))
    opening = (
        earlier.join(prior, (F.col("book_id") == F.col("pb")) & (F.col("rank") == F.col("pr")), "left")
        .select("book_id", "block_ord", (F.col("paras") > F.coalesce("before", F.lit(0))).alias("opens"))
    )
    marked = counted.join(opening, ["book_id", "block_ord"], "left").withColumn("opens", F.coalesce("opens", F.lit(False)))
    content = (F.col("kind") == "paragraph") | ((F.col("kind") == "heading") & (F.col("level") > 1))
    chaptered = running(
        marked, ["book_id"], ["block_ord"], "seg",
        chapter_index=("sum", F.col("opens").cast("int")), 
        broke=("max", F.when(F.col("kind") == "scene_break", F.col("block_ord"))), nth=("sum", content.cast("int")),
    )
    rows = chaptered.where(content)
    before = rows.select(F.col("book_id").alias("qb"), (F.col("nth") + 1).alias("qn"), F.col("block_ord").alias("q_ord"), F.col("kind").alias("q_kind"), F.col("chapter_index").alias("q_chapter"))
    linked = rows.join(before, (F.col("book_id") == F.col("qb")) & (F.col("nth") == F.col("qn")), "left")
    first = F.col("q_ord").isNull() | (F.col("q_chapter") != F.col("chapter_index"))
    new = first | ((F.col("kind") == "heading") & (F.col("q_kind") == "paragraph")) | (is_p & (F.col("q_kind") == "paragraph") & F.coalesce(F.col("broke") > F.col("q_ord"), F.lit(False)))
    scened = running(linked.select("book_id", "block_ord", "seg", "kind", "text", "paras", "chapter_index", new.cast("int").alias("new"), first.alias("first")), ["book_id"], ["block_ord"], "seg", scenes=("sum", F.col("new")))
    bases = scened.where("first").select("book_id", "chapter_index", F.col("scenes").alias("from"))
    placed = scened.join(bases, ["book_id", "chapter_index"]).select(
        "book_id", "chapter_index", (F.col("scenes") - F.col("from")).cast("int").alias("scene_index"), "block_ord", F.when(is_p, "paragraph").otherwise("scene_heading").alias("kind"), "text",
        F.when(is_p, F.col("paras") - 1).cast("int").alias("paragraph_index"),
    )
    titles = chaptered.where(top).select("book_id", "chapter_index", F.lit(None).cast("int").alias("scene_index"), "block_ord", F.lit("chapter_heading").alias("kind"), "text", F.lit(None).cast("int").alias("paragraph_index"))
    got = placed.unionByName(titles)
    # chapters without scenes and without a title vanish; the others are counted without holes
    alive = got.where("kind <> 'chapter_heading' or trim(text) <> ''").select("book_id", "chapter_index").distinct()
    dense = alive.withColumn("dense", F.row_number().over(W.partitionBy("book_id").orderBy("chapter_index")) - 1)
    return got.join(dense, ["book_id", "chapter_index"]).select("book_id", F.col("dense").cast("int").alias("chapter_index"), "scene_index", "block_ord", "kind", "text", "paragraph_index")


def paragraphs_of(tree: DataFrame) -> DataFrame:
    """book_id, chapter_index, scene_index, paragraph_index, text: paragraphs counted through the book."""
    return tree.where("kind = 'paragraph'").select("book_id", "chapter_index", "scene_index", "paragraph_index", "text", "block_ord")


def scenes_of(tree: DataFrame) -> DataFrame:
    """book_id, chapter_index, scene_index, headings, n_paragraphs."""
    rows = tree.where("scene_index is not null")
    heads = F.array_sort(F.collect_list(F.when(F.col("kind") == "scene_heading", F.struct("block_ord", "text"))))
    return rows.groupBy("book_id", "chapter_index", "scene_index").agg(F.transform(heads, lambda x: x["text"]).alias("headings"), F.count_if(F.col("kind") == "paragraph").cast("int").alias("n_paragraphs"))


def chapters_of(tree: DataFrame) -> DataFrame:
    """book_id, chapter_index, headings, title, n_scenes, n_paragraphs."""
    heads = F.array_sort(F.collect_list(F.when(F.col("kind") == "chapter_heading", F.struct("block_ord", "text"))))
    got = tree.groupBy("book_id", "chapter_index").agg(F.transform(heads, lambda x: x["text"]).alias("headings"), F.countDistinct("scene_index").cast("int").alias("n_scenes"), F.count_if(F.col("kind") == "paragraph").cast("int").alias("n_paragraphs"))
    return got.withColumn("title", F.get("headings", F.lit(0)))
