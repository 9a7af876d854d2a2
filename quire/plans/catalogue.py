"""The engine's own queries over the test tables, with DuckDB statements that say the same."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.functions import text as X
from quire.functions.tokens import CONTENT_BUDGET, proxy_tokens, word_count
from quire.operators import checks, packing, running, splits, stats, structure
from quire.plans import planted
from quire.plans.session import read_table
from quire.sources.files import mark_excluded

FLAGSHIP = "proxy_tokens"
#: Budget of the packing queries: small, so that scenes and paragraphs overflow.
SMALL = packing.PackConfig(max_seq_len=1026)
PATTERNS = ["*the_unending*", "shelf_0?/*", "omnibus", "*.docx"]


def _docs(spark: SparkSession, d: str) -> DataFrame:
    return read_table(spark, d, "documents")


def doc_lines(spark: SparkSession, d: str) -> DataFrame:
    """Lines of every document, numbered."""
    return structure.text_lines(_docs(spark, d).where("text is not null"), "doc_id").select("doc_id", "line_ord", "line")


def doc_words(spark: SparkSession, d: str) -> DataFrame:
    return _docs(spark, d).select("doc_id", word_count(F.col("text")).alias("n_words"))


def proxy_token_counts(spark: SparkSession, d: str) -> DataFrame:
    return _docs(spark, d).select("doc_id", proxy_tokens(F.col("text")).alias("n_tokens"))


def clean_blocks(spark: SparkSession, d: str) -> DataFrame:
    return read_table(spark, d, "blocks").where("text is not null").select("book_id", "block_ord", X.clean_inline(F.col("text")).alias("text")).distinct()


def clean_headings(spark: SparkSession, d: str) -> DataFrame:
    b = read_table(spark, d, "blocks").where("kind = 'heading' and text is not null")
    return b.select("book_id", "block_ord", X.clean_heading(F.col("text")).alias("heading"), X.heading_key(F.col("text")).alias("heading_key"), X.is_furniture(F.col("text")).alias("furniture")).distinct()


def slug_ids(spark: SparkSession, d: str) -> DataFrame:
    return read_table(spark, d, "book_specs").select("book_id", X.slugify(F.col("title")).alias("slug"), X.heading_key(F.col("title")).alias("title_key")).distinct()


def dehyphenated(spark: SparkSession, d: str) -> DataFrame:
    return read_table(spark, d, "blocks").where("text is not null").select("book_id", "block_ord", X.dehyphenate(X.normalise_newlines(F.col("text"))).alias("text")).distinct()


def line_classes(spark: SparkSession, d: str) -> DataFrame:
    """Lines of blocks by what they are: separators, chapter lines, Markdown headings, page numbers."""
    lines = structure.text_lines(read_table(spark, d, "blocks").where("text is not null").dropDuplicates(["book_id", "block_ord"]).withColumn("key", F.struct("book_id", "block_ord")), "key")
    line = F.col("line")
    return lines.select(
        F.col("key.book_id").alias("book_id"), F.col("key.block_ord").alias("block_ord"), "line_ord", X.is_scene_break(line).alias("scene_break"), X.is_numbered_break(line).alias("numbered"), X.is_chapter_line(line).alias("chapter_line"),
        F.coalesce(X.markdown_level(line), F.lit(0)).alias("md_level"), X.is_page_number(line).alias("page_number"),
    )


def omnibus_hints(spark: SparkSession, d: str) -> DataFrame:
    t = F.coalesce("title", F.lit(""))
    return read_table(spark, d, "book_specs").select("book_id", X.is_omnibus_hint(F.concat_ws(" ", t, F.array_join("sources", " "))).alias("omnibus"), X.is_book_label(t).alias("book_label"), X.is_nav_furniture(t).alias("nav_furniture")).distinct()


def document_blocks(spark: SparkSession, d: str) -> DataFrame:
    """Documents as plain text: headings, separators and paragraphs in order."""
    return structure.text_blocks(_docs(spark, d).where("text is not null").select("doc_id", "text"), "doc_id")


def markup_blocks(spark: SparkSession, d: str) -> DataFrame:
    """Documents as HTML: kinds and sizes of their blocks."""
    import pandas as pd

    from quire.sources.markup import html_blocks

    def run(batches):
        for b in batches:
            rows = [(i, o, k, len(t), lv) for i, text in zip(b["doc_id"], b["text"]) for o, (k, t, lv) in enumerate(html_blocks(text or "", "page.html"))]
            yield pd.DataFrame(rows, columns=["doc_id", "block_ord", "kind", "n_chars", "level"])

    return _docs(spark, d).select("doc_id", "text").mapInPandas(run, "doc_id long, block_ord int, kind string, n_chars int, level int")


def _tree(spark: SparkSession, d: str) -> DataFrame:
    return structure.hierarchy(read_table(spark, d, "blocks"))


def hierarchy(spark: SparkSession, d: str) -> DataFrame:
    return _tree(spark, d).select("book_id", "chapter_index", "scene_index", "block_ord", "kind")


def chapters(spark: SparkSession, d: str) -> DataFrame:
    return structure.chapters_of(_tree(spark, d)).select("book_id", "chapter_index", "title", "n_scenes", "n_paragraphs")


def scenes(spark: SparkSession, d: str) -> DataFrame:
    return structure.scenes_of(_tree(spark, d)).select("book_id", "chapter_index", "scene_index", F.size("headings").alias("n_headings"), "n_paragraphs")


def running_heads(spark: SparkSession, d: str) -> DataFrame:
    """Headings that survive, by book."""
    kept = structure.drop_running_heads(read_table(spark, d, "blocks").where("kind = 'heading'").select("book_id", "block_ord", "kind", "text").distinct(), read_table(spark, d, "book_specs").select("book_id", "title"))
    return kept.groupBy("book_id").agg(F.count("*").alias("n_headings"))


def _packed(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    tree = _tree(spark, d)
    books = read_table(spark, d, "book_specs").select("book_id", "title", F.col("sources").alias("source_files"))
    return packing.pack(tree, books, SMALL, kept=False)  # each query reads one of both, once


def pack_chunks(spark: SparkSession, d: str) -> DataFrame:
    return _packed(spark, d)[0].select("id", "book_id", "n_tokens", "chapter_index", "chapter_title", "paragraph_index_start", "paragraph_index_end", "n_paragraphs", "order_in_book", "flags")


def pack_oversize(spark: SparkSession, d: str) -> DataFrame:
    return _packed(spark, d)[1]


def oversize_by_kind(spark: SparkSession, d: str) -> DataFrame:
    return stats.oversize_by_kind(_packed(spark, d)[1])


def pack_totals(spark: SparkSession, d: str) -> DataFrame:
    return stats.chunk_totals(_packed(spark, d)[0], SMALL.budget)


def oversize_paragraphs(spark: SparkSession, d: str) -> DataFrame:
    p = read_table(spark, d, "paragraphs").groupBy("book_id", "paragraph_index").agg(F.max(proxy_tokens(F.col("text"))).alias("n_tokens"))
    return p.where("n_tokens > 512")


def book_stats(spark: SparkSession, d: str) -> DataFrame:
    return stats.book_stats(read_table(spark, d, "paragraphs"))


def length_summary(spark: SparkSession, d: str) -> DataFrame:
    return stats.length_summary(read_table(spark, d, "chunks").groupBy("id").agg(F.max(proxy_tokens(F.col("text"))).alias("n_tokens")))


def chunk_totals(spark: SparkSession, d: str) -> DataFrame:
    return stats.chunk_totals(read_table(spark, d, "chunks").dropDuplicates(["id"]), CONTENT_BUDGET).select(
        "n_chunks", "content_tokens", "boundary_tokens", "total_tokens", "utilisation", "starts_chapter", "starts_scene", "ends_scene", "continues_scene", "ends_scene_pct"
    )


def _one_chunks(spark: SparkSession, d: str) -> DataFrame:
    c = read_table(spark, d, "chunks")
    return c.select("id", "book_id", "chapter_index", "order_in_book", "paragraph_index_start", "paragraph_index_end", "paragraph_index_gaps", "n_tokens", "source_files").dropDuplicates(["id"])


def budget_check(spark: SparkSession, d: str) -> DataFrame:
    return checks.over_budget(_one_chunks(spark, d), 512)


def duplicate_check(spark: SparkSession, d: str) -> DataFrame:
    """Paragraphs in two chunks, once the chunks of the test split stand there twice."""
    c = _one_chunks(spark, d)
    test = read_table(spark, d, "chunks").where("lower(trim(split)) = 'test'").select("id").distinct()
    return checks.repeated_paragraphs(c.unionByName(c.join(test, "id", "left_semi").withColumn("id", F.concat("id", F.lit("#")))))


def order_check(spark: SparkSession, d: str) -> DataFrame:
    """Chunks that start before the one they follow, with the order of each book turned round."""
    return checks.out_of_order(_one_chunks(spark, d).withColumn("order_in_book", -F.col("order_in_book")))


def source_check(spark: SparkSession, d: str) -> DataFrame:
    """Chunks that name a file twice, once those of multi-scene chunks are named again."""
    twice = F.when(F.col("flags.spans_multiple_scenes"), F.concat("source_files", "source_files")).otherwise(F.col("source_files"))
    c = read_table(spark, d, "chunks").select("id", "flags", "source_files").dropDuplicates(["id"])
    return checks.repeated_sources(c.withColumn("source_files", twice)).select("id")


def index_gaps(spark: SparkSession, d: str) -> DataFrame:
    """Paragraphs missing from the books, once those under twenty tokens are left out."""
    return checks.index_gaps(read_table(spark, d, "paragraphs").where(proxy_tokens(F.col("text")) >= 20))


def ornaments(spark: SparkSession, d: str) -> DataFrame:
    """Characters that part scenes alone, or three of them in a row."""
    c = F.decode(F.unhex(F.lpad(F.hex("id"), 4, "0")), "UTF-16BE")
    codes = spark.range(33, 12_288).withColumn("c", c)
    return codes.select(F.col("id").alias("code"), X.is_scene_break(F.col("c")).alias("alone"), X.is_scene_break(F.repeat("c", F.lit(3))).alias("in_a_row")).where("alone or in_a_row")


def paragraph_cover(spark: SparkSession, d: str) -> DataFrame:
    """Chunks that hold each paragraph of the packed books: one, or none for a paragraph dearer than the budget."""
    tree = _tree(spark, d)
    held = checks.covered_paragraphs(_packed(spark, d)[0]).groupBy("book_id", "paragraph_index").agg(F.count("*").alias("n"))
    return structure.paragraphs_of(tree).select("book_id", "paragraph_index").join(held, ["book_id", "paragraph_index"], "left").select("book_id", "paragraph_index", F.coalesce("n", F.lit(0)).alias("n_chunks"))


def packed_words(spark: SparkSession, d: str) -> DataFrame:
    """Words of each packed book that the chunks hold, headings left out: all but those of dearer paragraphs."""
    packed = packing.pack(_tree(spark, d), read_table(spark, d, "book_specs").select("book_id", "title", F.col("sources").alias("source_files")), replace(SMALL, chapter_headings=False, scene_headings=False), kept=False)[0]
    return packed.groupBy("book_id").agg(F.sum(word_count(F.col("text"))).alias("n_words"), F.sum("n_paragraphs").alias("n_paragraphs"))


def chunk_gaps(spark: SparkSession, d: str) -> DataFrame:
    """Paragraphs that the chunks hold, by chunk."""
    return checks.covered_paragraphs(_one_chunks(spark, d)).groupBy("id").agg(F.count("*").alias("n_covered"))


def ends_scene(spark: SparkSession, d: str) -> DataFrame:
    """Whether a chunk's last paragraph is the last of a scene."""
    last = read_table(spark, d, "scenes").select("book_id", F.array_max(F.transform("paragraphs", lambda p: p["paragraph_index"])).alias("paragraph_index_end")).distinct().withColumn("hit", F.lit(True))
    c = _one_chunks(spark, d).select("id", "book_id", "paragraph_index_end")
    return c.join(last, ["book_id", "paragraph_index_end"], "left").select("id", F.coalesce("hit", F.lit(False)).alias("ends_scene"))


def stable_units(spark: SparkSession, d: str) -> DataFrame:
    return read_table(spark, d, "book_specs").select("book_id").distinct().select("book_id", F.round(splits.stable_unit(F.col("book_id")), 9).alias("unit"))


def val_books(spark: SparkSession, d: str) -> DataFrame:
    return splits.choose_val_books(read_table(spark, d, "book_specs"), 0.1)


def split_by_book(spark: SparkSession, d: str) -> DataFrame:
    c = _one_chunks(spark, d)
    return stats.split_totals(splits.assign_splits(c, "book", 0.1))


def split_by_chapter(spark: SparkSession, d: str) -> DataFrame:
    return splits.assign_splits(_one_chunks(spark, d), "chapter", 0.1).select("id", "split")


def exclude_globs(spark: SparkSession, d: str) -> DataFrame:
    books = read_table(spark, d, "book_specs").dropDuplicates(["book_id"])
    return mark_excluded(books, PATTERNS).where("matched_pattern is not null").select("book_id", "matched_pattern")


def chunk_offsets(spark: SparkSession, d: str) -> DataFrame:
    """Where each chunk's tokens lie in one stream of all chunks in order, with two boundary tokens each."""
    c = _one_chunks(spark, d).select("id", "book_id", "order_in_book", (F.coalesce("n_tokens", F.lit(0)) + 2).cast("long").alias("seq_len"))
    s = running.global_running_sum(c, ["book_id", "order_in_book", "id"], "seq_len", "end")
    return s.select("id", (F.col("end") - F.col("seq_len")).alias("start"), "end", "seq_len")


def collate_lengths(spark: SparkSession, d: str) -> DataFrame:
    """Padded length of batches of eight chunks in stream order: the longest, rounded up to a multiple of eight."""
    c = _one_chunks(spark, d).select("book_id", "id", "order_in_book", (F.coalesce("n_tokens", F.lit(0)) + 2).alias("seq_len"), F.lit(1).alias("one"))
    n = running.global_running_sum(c, ["book_id", "order_in_book", "id"], "one", "n").withColumn("batch", F.floor((F.col("n") - 1) / 8))
    return n.groupBy("batch").agg(F.count("*").alias("n_chunks"), (F.ceil(F.max("seq_len") / 8) * 8).cast("long").alias("padded"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """Name -> query over the tables of a folder."""
    return {
        "proxy_tokens": proxy_token_counts, "doc_lines": doc_lines, "doc_words": doc_words, "clean_inline_blocks": clean_blocks, "clean_headings": clean_headings, "slug_ids": slug_ids, "dehyphenate": dehyphenated,
        "line_classes": line_classes, "omnibus_hints": omnibus_hints, "document_blocks": document_blocks, "html_blocks": markup_blocks, "hierarchy": hierarchy, "chapters": chapters, "scenes": scenes,
        "running_heads": running_heads, "pack_chunks": pack_chunks, "pack_oversize": pack_oversize, "oversize_by_kind": oversize_by_kind, "pack_totals": pack_totals, "oversize_paragraphs": oversize_paragraphs,
        "book_stats": book_stats, "length_summary": length_summary, "chunk_totals": chunk_totals, "budget_check": budget_check, "dup_check": duplicate_check, "order_check": order_check, "source_check": source_check,
        "index_gaps": index_gaps, "chunk_coverage": chunk_gaps, "ends_scene_flags": ends_scene, "stable_units": stable_units, "val_books": val_books, "split_by_book": split_by_book, "split_by_chapter": split_by_chapter,
        "ornaments": ornaments, "paragraph_cover": paragraph_cover, "packed_words": packed_words, "exclude_globs": exclude_globs, "chunk_offsets": chunk_offsets, "collate_lengths": collate_lengths,
    } | planted.queries()


# SQL: its constants are written out here on their own, so that a wrong value elsewhere shows -------------------
_ORNAMENTS = (
    r"\x{21}\x{23}\x{2a}\x{2d}\x{2e}\x{3d}\x{3f}\x{5f}\x{7e}\x{a1}\x{a7}\x{b6}\x{b7}\x{bf}\x{2013}\x{2014}\x{2016}-\x{2019}\x{201c}\x{201d}\x{2020}-\x{2022}\x{2042}-\x{2046}\x{2049}\x{204c}-\x{205e}"
    r"\x{25a0}\x{25a1}\x{25aa}\x{25ab}\x{25c6}\x{25c7}\x{25c9}\x{25cb}\x{25ce}-\x{25d1}\x{25e6}\x{2660}-\x{266f}\x{26aa}\x{26ab}\x{2731}-\x{273d}\x{273f}-\x{274e}\x{2750}-\x{2756}\x{2758}-\x{275e}\x{2b1a}-\x{2b1e}\x{2b24}-\x{2b2f}"
)
_STRONG = r"\x{7e}\x{a7}\x{b6}\x{2020}\x{2021}\x{2042}-\x{2044}\x{2049}\x{2053}\x{25a0}\x{25a1}\x{25aa}\x{25ab}\x{25c6}\x{25c7}\x{2660}-\x{266f}\x{2731}-\x{2735}\x{274a}-\x{274e}\x{2756}\x{2758}-\x{275e}\x{2b1a}"
_CHAPTER = (
    r"(?i)^[\s\p{Z}\x0B\x{85}]*(?:chapter|part|book|section|canto|volume|act|scene|stave|prologue|epilogue|interlude|afterword|foreword|preface|introduction|appendix|postscript|envoi|proem)\b[\s\p{Z}\x0B\x{85}.:\x{2014}\x{2013}-]*"
    r"(?:\d{1,3}|[ivxlcdm]{1,7}|one|two|three|four|five|six|seven|eight|nine|ten|eleven|twelve|thirteen|fourteen|fifteen|sixteen|seventeen|eighteen|nineteen|twenty|thirty|forty|fifty|sixty|seventy|eighty|ninety|hundred)?\b[^\n]{0,60}$"
)
_FURNITURE = (
    "'contents', 'table of contents', 'cover', 'title page', 'copyright', 'copyright page', 'dedication', 'acknowledgements', 'acknowledgments', 'about the author', 'about the publisher', 'also by', 'praise', "
    "'advertisement', 'colophon', 'epigraph', 'half title', 'end matter', 'front matter', 'back matter', 'glossary', 'index', 'notes'"
)
_NAVIGATION = "'', 'cover', 'copyright', 'contents', 'table of contents', 'title page', 'dedication', 'acknowledgements', 'acknowledgments', 'about the author', 'about', 'also by', 'colophon', 'title'"
_INVISIBLE = r"\x{200b}\x{200c}\x{200d}\x{200e}\x{200f}\x{feff}\x{ad}\x{2060}"
#: The exclusion patterns by hand: anything around, one sign, a part of a name, an ending.
_GLOBS = {"*the_unending*": "the_unending", "shelf_0?/*": "^shelf_0./", "omnibus": "omnibus", "*.docx": "[.]docx$"}
_S = r"[\s\p{Z}\x0B\x{85}]"
_NOT_S = r"[^\s\p{Z}\x0B\x{85}]"
_W = r"[\p{L}\p{Nd}\p{Nl}\p{M}\p{Pc}\x{200C}\x{200D}]"
_NOT_W_S = r"[^\p{L}\p{Nd}\p{Nl}\p{M}\p{Pc}\x{200C}\x{200D}\s\p{Z}\x0B\x{85}]"


def sql_tokens(c: str) -> str:
    """The approximate price in DuckDB."""
    w, q = f"coalesce(len(regexp_extract_all({c}, '{_NOT_S}+')), 0)::DOUBLE", f"coalesce(len(regexp_extract_all({c}, '{_NOT_W_S}')), 0)::DOUBLE"
    return f"CAST(trunc({w} + 0.3::DOUBLE * {w} + 0.5::DOUBLE * {q}) AS INTEGER)"


def _trim(c: str) -> str:
    return rf"regexp_replace({c}, '^[\s\p{{Z}}\x0B\x{{85}}\x{{1c}}-\x{{1f}}]+|[\s\p{{Z}}\x0B\x{{85}}\x{{1c}}-\x{{1f}}]+$', '', 'g')"


def _clean(c: str) -> str:
    c = f"regexp_replace(nfc_normalize({c}), '[{_INVISIBLE}]', '', 'g')"
    c = rf"regexp_replace({c}, '[\x{{a0}}\x{{2028}}\x{{2029}}]', ' ', 'g')"
    c = rf"regexp_replace({c}, '[\t\x0B\f\r\x{{85}}\p{{Z}}]+', ' ', 'g')"
    c = rf"regexp_replace({c}, '{_S}+([,.;:!?\x{{2026}}])', '\1', 'g')"
    return _trim(c)


def _key(c: str) -> str:
    return f"trim(regexp_replace(lower({c}), '[^a-z0-9]+', ' ', 'g'))"


def _newlines(c: str) -> str:
    return rf"regexp_replace(regexp_replace({c}, '\r\n?', chr(10), 'g'), '\n{{3,}}', chr(10) || chr(10), 'g')"


_CHUNKS = "(SELECT DISTINCT ON (id) * FROM chunks)"
_B = "(SELECT DISTINCT ON (book_id, block_ord) * FROM blocks WHERE book_id IS NOT NULL AND block_ord IS NOT NULL)"
_HIERARCHY = f"""
    b AS (SELECT book_id, block_ord, kind, coalesce(text, '') AS text, coalesce(level, 0) AS level FROM {_B} WHERE kind <> 'paragraph' OR trim(coalesce(text, '')) <> ''),
    p AS (SELECT *, sum((kind = 'paragraph')::INT) OVER w - (kind = 'paragraph')::INT AS before, kind = 'heading' AND level <= 1 AS head FROM b WINDOW w AS (PARTITION BY book_id ORDER BY block_ord)),
    o AS (SELECT *, head AND before > coalesce(max(CASE WHEN head THEN before END) OVER (PARTITION BY book_id ORDER BY block_ord ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS opens FROM p),
    c AS (SELECT *, sum(opens::INT) OVER (PARTITION BY book_id ORDER BY block_ord) AS chapter, max(CASE WHEN kind = 'scene_break' THEN block_ord END) OVER (PARTITION BY book_id ORDER BY block_ord) AS broke FROM o),
    r AS (SELECT *, lag(kind) OVER v AS qk, lag(block_ord) OVER v AS qo FROM c WHERE kind = 'paragraph' OR (kind = 'heading' AND level > 1) WINDOW v AS (PARTITION BY book_id, chapter ORDER BY block_ord)),
    s AS (SELECT *, sum((qk IS NULL OR (kind = 'heading' AND qk = 'paragraph') OR (kind = 'paragraph' AND qk = 'paragraph' AND coalesce(broke > qo, false)))::INT) OVER (PARTITION BY book_id, chapter ORDER BY block_ord) - 1 AS scene FROM r),
    u AS (SELECT book_id, chapter, scene, block_ord, CASE WHEN kind = 'paragraph' THEN kind ELSE 'scene_heading' END AS kind, text FROM s
          UNION ALL SELECT book_id, chapter, NULL, block_ord, 'chapter_heading', text FROM c WHERE head),
    n AS (SELECT *, dense_rank() OVER (PARTITION BY book_id ORDER BY chapter) - 1 AS ci FROM u WHERE EXISTS (SELECT 1 FROM u a WHERE a.book_id = u.book_id AND a.chapter = u.chapter AND (a.kind <> 'chapter_heading' OR trim(a.text) <> '')))
"""


def oracle_sql() -> dict[str, str]:
    """Name -> DuckDB statement."""
    orn, strong, chapter = _ORNAMENTS, _STRONG, _CHAPTER
    line = _trim("line")
    brk = f"""(len({line}) BETWEEN 1 AND 40 AND (regexp_matches({line}, '^[{strong}]$') OR (len({line}) >= 3 AND regexp_matches({line}, '^[{orn}\\s\\p{{Z}}]+$') AND len(regexp_replace({line}, '{_S}', '', 'g')) >= 3)))"""
    md = r"^[\s\p{Z}]{0,3}(#{1,6})[\s\p{Z}]+(.+?)[\s\p{Z}]*#*[\s\p{Z}]*$"
    lines = f"SELECT book_id, block_ord, unnest(string_split({_newlines('text')}, chr(10))) AS line, generate_subscripts(string_split({_newlines('text')}, chr(10)), 1) - 1 AS line_ord FROM {_B} WHERE text IS NOT NULL"
    unit = "('0x' || substr(sha1({}), 1, 12))::BIGINT::DOUBLE / 281474976710656.0"
    seq = "(coalesce(n_tokens, 0) + 2)::BIGINT"
    stream = "ORDER BY book_id, order_in_book, id"
    globs = " ".join(f"WHEN list_bool_or(list_transform(fields, lambda x: regexp_matches(lower(x), '{rule}', 's'))) THEN '{p}'" for p, rule in _GLOBS.items())
    val = f"(SELECT book_id FROM (SELECT book_id, row_number() OVER (ORDER BY {unit.format('book_id')}, book_id) AS r, count(*) OVER () AS n FROM (SELECT DISTINCT book_id FROM {{src}} WHERE book_id IS NOT NULL)) WHERE r <= least(greatest(1, round_even(n * 0.1::DOUBLE, 0)), n - 1))"
    pct = ", ".join(f"min(CASE WHEN r - 1 = round_even({p / 100.0}::DOUBLE * (n - 1)::DOUBLE, 0) THEN t END) AS p{p:02d}" for p in stats.PERCENTILES)
    w = "WINDOW w AS (PARTITION BY doc_id ORDER BY o ROWS UNBOUNDED PRECEDING)"
    dehyphen = rf"regexp_replace(raw, '({_W})-\n({_W})', '\1\2', 'g')"
    body = f"list_aggregate(list_transform(string_split({dehyphen}, chr(10)), lambda x: {_trim('x')}), 'string_agg', ' ')"
    head = f"CASE WHEN regexp_matches(first, '{md}') THEN regexp_extract(first, '{md}', 2) ELSE first END"
    document_blocks = f"""WITH l AS (SELECT doc_id, unnest(string_split({_newlines('text')}, chr(10))) AS line, generate_subscripts(string_split({_newlines('text')}, chr(10)), 1) - 1 AS o FROM documents WHERE text IS NOT NULL),
        c AS (SELECT *, CASE WHEN {line} = '' THEN 'blank' WHEN regexp_matches(line, '{md}') THEN 'heading' WHEN {brk} THEN 'scene_break' WHEN len({line}) <= 70 AND regexp_matches({line}, '{chapter}') THEN 'candidate' ELSE 'prose' END AS cls FROM l),
        m AS (SELECT *, coalesce(last_value(CASE WHEN cls <> 'candidate' THEN cls = 'prose' END IGNORE NULLS) OVER w, false) AS opened FROM c {w}),
        k AS (SELECT *, CASE WHEN cls = 'candidate' THEN CASE WHEN opened THEN 'prose' ELSE 'heading' END ELSE cls END AS kind FROM m),
        r AS (SELECT *, CASE WHEN kind = 'prose' THEN coalesce(max(CASE WHEN kind <> 'prose' THEN o END) OVER w, -1) + 1 ELSE o END AS run FROM k {w}),
        b AS (SELECT doc_id, kind, run, string_agg(line, chr(10) ORDER BY o) AS raw, min_by(line, o) AS first FROM r WHERE kind <> 'blank' GROUP BY doc_id, kind, run),
        t AS (SELECT doc_id, run, CASE kind WHEN 'prose' THEN 'paragraph' ELSE kind END AS kind, CASE kind WHEN 'prose' THEN {_clean(body)} WHEN 'heading' THEN {_trim(f"regexp_replace({_clean(head)}, '^[ .—–-]+|[ .—–-]+$', '', 'g')")} ELSE '' END AS text,
            CASE WHEN kind <> 'heading' THEN 0 WHEN regexp_matches(first, '{md}') AND len(regexp_extract(first, '{md}', 1)) > 2 THEN 2 ELSE 1 END AS level FROM b)
        SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY run) - 1 AS block_ord, kind, text, level FROM t WHERE kind = 'scene_break' OR text <> ''"""
    q = {
        "document_blocks": document_blocks,
        "proxy_tokens": f"SELECT doc_id, {sql_tokens('text')} AS n_tokens FROM documents",
        "doc_words": f"SELECT doc_id, coalesce(len(regexp_extract_all(text, '{_NOT_S}+')), 0)::INTEGER AS n_words FROM documents",
        "doc_lines": f"SELECT doc_id, (generate_subscripts(string_split({_newlines('text')}, chr(10)), 1) - 1)::INTEGER AS line_ord, unnest(string_split({_newlines('text')}, chr(10))) AS line FROM documents WHERE text IS NOT NULL",
        "clean_inline_blocks": f"SELECT DISTINCT book_id, block_ord, {_clean('text')} AS text FROM blocks WHERE text IS NOT NULL",
        "clean_headings": f"""SELECT DISTINCT book_id, block_ord, {_trim(f"regexp_replace({_clean('text')}, '^[ .—–-]+|[ .—–-]+$', '', 'g')")} AS heading, {_key('text')} AS heading_key, {_key('text')} IN ({_FURNITURE}) AS furniture FROM blocks WHERE kind = 'heading' AND text IS NOT NULL""",
        "slug_ids": f"SELECT DISTINCT book_id, lower(regexp_replace(regexp_replace(title, '[^A-Za-z0-9]+', '_', 'g'), '^_+|_+$', '', 'g')) AS slug, {_key('title')} AS title_key FROM book_specs",
        "dehyphenate": rf"SELECT DISTINCT book_id, block_ord, regexp_replace({_newlines('text')}, '({_W})-\n({_W})', '\1\2', 'g') AS text FROM blocks WHERE text IS NOT NULL",
        "line_classes": f"""SELECT book_id, block_ord, line_ord::INTEGER AS line_ord, {brk} AS scene_break, regexp_matches({line}, '^[1-9][0-9]{{0,2}}$') AS numbered, regexp_matches(line, '{chapter}') AS chapter_line,
            CASE WHEN regexp_matches(line, '{md}') THEN CASE WHEN len(regexp_extract(line, '{md}', 1)) <= 2 THEN 1 ELSE 2 END ELSE 0 END AS md_level, regexp_matches({line}, '(?i)^(\\d{{1,4}}|page\\s+\\d{{1,4}}(\\s+of\\s+\\d{{1,4}})?)$') AS page_number FROM ({lines})""",
        "hierarchy": f"WITH {_HIERARCHY} SELECT book_id, ci::INTEGER AS chapter_index, scene::INTEGER AS scene_index, block_ord, kind FROM n",
        "chapters": f"WITH {_HIERARCHY} SELECT book_id, ci::INTEGER AS chapter_index, min_by(text, block_ord) FILTER (kind = 'chapter_heading') AS title, count(DISTINCT scene)::INTEGER AS n_scenes, count(*) FILTER (kind = 'paragraph')::INTEGER AS n_paragraphs FROM n GROUP BY ALL",
        "scenes": f"WITH {_HIERARCHY} SELECT book_id, ci::INTEGER AS chapter_index, scene::INTEGER AS scene_index, count(*) FILTER (kind = 'scene_heading')::INTEGER AS n_headings, count(*) FILTER (kind = 'paragraph')::INTEGER AS n_paragraphs FROM n WHERE scene IS NOT NULL GROUP BY ALL",
        "running_heads": f"""SELECT h.book_id, count(*) AS n_headings FROM (SELECT DISTINCT book_id, block_ord, kind, text FROM blocks WHERE kind = 'heading') h LEFT JOIN (SELECT book_id, max(title) AS title FROM book_specs GROUP BY 1) t USING (book_id)
            WHERE NOT coalesce(coalesce({_key('text')} = {_key("coalesce(title, '')")}, false) OR {_key('text')} IN ({_FURNITURE}), false) GROUP BY 1""",
        "oversize_paragraphs": f"SELECT book_id, paragraph_index, max({sql_tokens('text')}) AS n_tokens FROM paragraphs GROUP BY 1, 2 HAVING max({sql_tokens('text')}) > 512",
        "book_stats": f"""WITH p AS (SELECT book_id, paragraph_index, max(chapter_index) AS c, max(scene_index) AS s, max(coalesce(len(regexp_extract_all(text, '{_NOT_S}+')), 0)) AS w, max({sql_tokens('text')}) AS t FROM paragraphs GROUP BY 1, 2)
            SELECT book_id, count(DISTINCT c) AS n_chapters, count(DISTINCT (c, s)) FILTER (c IS NOT NULL AND s IS NOT NULL) AS n_scenes, count(*) AS n_paragraphs, sum(w)::BIGINT AS n_words, sum(t)::BIGINT AS n_tokens FROM p GROUP BY 1""",
        "length_summary": f"WITH t AS (SELECT id, max({sql_tokens('text')}) AS t FROM chunks GROUP BY 1), x AS (SELECT t, row_number() OVER (ORDER BY t) AS r, count(*) OVER () AS n FROM t) SELECT max(n) AS n, min(t) AS min, max(t) AS max, round(sum(t) / max(n), 1) AS mean, {pct} FROM x",
        "chunk_totals": f"""SELECT count(*) AS n_chunks, coalesce(sum(n_tokens), 0)::BIGINT AS content_tokens, count(*) * 2 AS boundary_tokens, (coalesce(sum(n_tokens), 0) + count(*) * 2)::BIGINT AS total_tokens, round(coalesce(sum(n_tokens), 0) / (count(*) * {CONTENT_BUDGET}.0::DOUBLE), 4) AS utilisation,
            count(*) FILTER (flags.starts_chapter) AS starts_chapter, count(*) FILTER (flags.starts_scene) AS starts_scene, count(*) FILTER (flags.ends_scene) AS ends_scene, count(*) FILTER (flags.continues_scene) AS continues_scene, round(100.0::DOUBLE * count(*) FILTER (flags.ends_scene) / count(*), 2) AS ends_scene_pct FROM {_CHUNKS}""",
        "budget_check": f"SELECT id, n_tokens FROM {_CHUNKS} WHERE n_tokens > 512",
        "dup_check": f"""WITH t AS (SELECT DISTINCT id FROM chunks WHERE lower(trim(split)) = 'test'), c AS (SELECT id, book_id, paragraph_index_start, paragraph_index_end, paragraph_index_gaps FROM {_CHUNKS}),
            u AS (SELECT * FROM c UNION ALL SELECT id || '#', book_id, paragraph_index_start, paragraph_index_end, paragraph_index_gaps FROM c SEMI JOIN t USING (id)),
            e AS (SELECT id, book_id, unnest(list_filter(range(paragraph_index_start, paragraph_index_end + 1), lambda i: NOT list_contains(coalesce(paragraph_index_gaps, []), i)))::INTEGER AS paragraph_index FROM u WHERE paragraph_index_start >= 0)
            SELECT book_id, paragraph_index, count(DISTINCT id) AS n_chunks FROM e GROUP BY 1, 2 HAVING count(DISTINCT id) > 1""",
        "order_check": f"WITH c AS (SELECT DISTINCT id, book_id, -order_in_book AS order_in_book, paragraph_index_start AS p FROM {_CHUNKS}) SELECT a.id, a.book_id, a.order_in_book FROM c a JOIN c b ON a.book_id = b.book_id AND a.order_in_book = b.order_in_book + 1 WHERE a.p < b.p",
        "source_check": f"SELECT id FROM {_CHUNKS} WHERE len(list_distinct(source_files)) < len(source_files) OR (flags.spans_multiple_scenes AND len(source_files) > 0)",
        "index_gaps": f"WITH p AS (SELECT DISTINCT book_id, paragraph_index AS i FROM paragraphs WHERE book_id IS NOT NULL AND paragraph_index IS NOT NULL AND {sql_tokens('text')} >= 20), r AS (SELECT book_id, unnest(range(min(i), max(i) + 1))::INTEGER AS i FROM p GROUP BY 1) SELECT r.book_id, r.i AS paragraph_index FROM r ANTI JOIN p USING (book_id, i)",
        "ornaments": f"SELECT i AS code, regexp_matches(chr(i::INTEGER), '^[{strong}]$') AS alone, regexp_matches(chr(i::INTEGER), '^[{orn}]$') AS in_a_row FROM range(33, 12288) t(i) WHERE regexp_matches(chr(i::INTEGER), '^[{strong}{orn}]$')",
        "paragraph_cover": f"WITH {_HIERARCHY} SELECT book_id, (row_number() OVER (PARTITION BY book_id ORDER BY block_ord) - 1)::INTEGER AS paragraph_index, ({sql_tokens('text')} <= 1024)::BIGINT AS n_chunks FROM n WHERE kind = 'paragraph'",
        "packed_words": f"WITH {_HIERARCHY} SELECT book_id, sum(len(regexp_extract_all(text, '{_NOT_S}+')))::BIGINT AS n_words, count(*) AS n_paragraphs FROM n WHERE kind = 'paragraph' AND {sql_tokens('text')} <= 1024 GROUP BY 1",
        "chunk_coverage": f"SELECT id, len(list_filter(range(paragraph_index_start, paragraph_index_end + 1), lambda i: NOT list_contains(coalesce(paragraph_index_gaps, []), i))) AS n_covered FROM {_CHUNKS} WHERE paragraph_index_start >= 0 AND paragraph_index_end >= paragraph_index_start",
        "ends_scene_flags": f"SELECT c.id, l.book_id IS NOT NULL AS ends_scene FROM {_CHUNKS} c LEFT JOIN (SELECT DISTINCT book_id, list_max(list_transform(paragraphs, lambda p: p.paragraph_index)) AS e FROM scenes) l ON l.book_id = c.book_id AND l.e = c.paragraph_index_end",
        "stable_units": f"SELECT DISTINCT book_id, round({unit.format('book_id')}, 9) AS unit FROM book_specs",
        "val_books": f"SELECT book_id FROM {val.format(src='book_specs')}",
        "split_by_book": f"SELECT CASE WHEN book_id IN (SELECT book_id FROM {val.format(src=_CHUNKS)}) THEN 'val' ELSE 'train' END AS split, count(*) AS n_chunks, coalesce(sum(n_tokens), 0)::BIGINT AS n_tokens FROM {_CHUNKS} GROUP BY 1",
        "split_by_chapter": f"SELECT id, CASE WHEN {unit.format(chr(40) + 'book_id || ' + repr('::') + ' || chapter_index' + chr(41))} < 0.1::DOUBLE THEN 'val' ELSE 'train' END AS split FROM {_CHUNKS}",
        "exclude_globs": f"""WITH f AS (SELECT DISTINCT ON (book_id) book_id, list_filter([book_id, title, series, group_key] || list_transform(sources, lambda s: string_split(s, '/')[-1]) || list_transform(sources, lambda s: regexp_replace(string_split(s, '/')[-1], '\\.[^.]+$', '')) || list_transform(sources, lambda s: coalesce(string_split(s, '/')[-2], '')), lambda x: coalesce(x, '') <> '') AS fields FROM book_specs)
            SELECT * FROM (SELECT book_id, CASE {globs} END AS matched_pattern FROM f) WHERE matched_pattern IS NOT NULL""",
        "chunk_offsets": f"SELECT id, (sum({seq}) OVER ({stream}) - {seq})::BIGINT AS start, (sum({seq}) OVER ({stream}))::BIGINT AS end, {seq} AS seq_len FROM {_CHUNKS}",
        "collate_lengths": f"WITH s AS (SELECT {seq} AS l, (row_number() OVER ({stream}) - 1) // 8 AS batch FROM {_CHUNKS}) SELECT batch, count(*) AS n_chunks, (ceil(max(l) / 8.0) * 8)::BIGINT AS padded FROM s GROUP BY 1",
        "omnibus_hints": rf"""SELECT DISTINCT book_id, regexp_matches(coalesce(title, '') || ' ' || array_to_string(sources, ' '), '(?i)\b(trilogy|omnibus|boxed[\s-]?set|complete series|complete collection|e-?book boxed|boxed e-?book)\b') AS omnibus, regexp_matches(coalesce(title, ''), '(?i)^\s*(book|volume|tome)\s+(one|two|three|four|five|six|seven|eight|nine|ten|eleven|twelve|i{{1,3}}|iv|v|vi{{0,3}}|ix|\d{{1,2}})\b') AS book_label,
            (trim(lower(coalesce(title, ''))) IN ({_NAVIGATION}) OR starts_with(trim(lower(coalesce(title, ''))), 'about ')) AS nav_furniture FROM book_specs""",
    }
    return q | planted.oracle_sql(_CHUNKS, sql_tokens, unit)
