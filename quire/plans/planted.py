"""Queries over planted files and rows, for operators that the test tables do not reach, with the rows they must give.

The expected rows are worked out by hand from the rules and stand here as VALUES; nothing of the engine goes into them.
"""

from __future__ import annotations

import base64
import contextlib
import io
import shutil
import uuid
from collections.abc import Callable
from pathlib import Path
from urllib.parse import urlparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.functions import text as X
from quire.functions.tokens import proxy_tokens
from quire.operators import packing, splits, stats, structure
from quire.plans.session import cut_lineage, read_table, shared_dir
from quire.sources import demo, sinks
from quire.sources import files as sources


def _files(spark: SparkSession, files: dict[str, bytes]) -> DataFrame:
    return spark.createDataFrame([(k, bytearray(v)) for k, v in files.items()], "rel string, content binary")


def _documents(spark: SparkSession, files: dict[str, bytes], **options) -> DataFrame:
    return sources.extracted(_files(spark, files), **options)


def _blocks(spark: SparkSession, files: dict[str, bytes], **options) -> DataFrame:
    flat = _documents(spark, files, **options).select("rel", "doc_ord", F.explode("blocks").alias("b"))
    return flat.select("rel", "doc_ord", F.col("b.block_ord").cast("int").alias("block_ord"), "b.kind", "b.text", "b.level")


def _sets(spark: SparkSession, files: dict[str, bytes], **options) -> DataFrame:
    rows = _documents(spark, files, **options)
    meta = lambda k: F.coalesce(F.col("meta")[k], F.lit(""))
    return rows.select("rel", "doc_ord", "n_docs", meta("title").alias("title"), meta("part_index").alias("part"), F.size("blocks").alias("n_blocks"), F.coalesce(F.element_at("blocks", 1)["text"], F.lit("")).alias("first"))


H, B, P = "heading", "scene_break", "paragraph"

# Text, Markdown, encodings -------------------------------------------------
TEXTS = {
    "a.txt": "Chapter One\r\n\r\nThe old lan-\r\ntern  stood , near\r\nthe harbor.\r\n\r\n\r\n\r\n* * *\r\nNobody had\tthought of it.\r\nChapter two was open.".encode(),
    "b.md": b"# The Quiet Sea #\n\n### A part\nfirst words\n~~~\n#no heading\n-\n--\n---",
    "c.txt": "Café au lait — œuvre".encode("cp1252"),
    "d.markdown": b"\xef\xbb\xbfPrologue\n\n  \n\xc2\xa7\n\n12\n\nwords\xe2\x80\x8b of a zero\xc2\xa0width",
    "e.txt": b"",
}
TEXT_ROWS = [
    ("a.txt", 0, 0, H, "Chapter One", 1), ("a.txt", 0, 1, P, "The old lantern stood, near the harbor.", 0), ("a.txt", 0, 2, B, "", 0), ("a.txt", 0, 3, P, "Nobody had thought of it. Chapter two was open.", 0),
    ("b.md", 0, 0, H, "The Quiet Sea", 1), ("b.md", 0, 1, H, "A part", 2), ("b.md", 0, 2, P, "first words", 0), ("b.md", 0, 3, B, "", 0), ("b.md", 0, 4, P, "#no heading - --", 0), ("b.md", 0, 5, B, "", 0),
    ("c.txt", 0, 0, P, "Café au lait — œuvre", 0), ("d.markdown", 0, 0, H, "Prologue", 1), ("d.markdown", 0, 1, B, "", 0), ("d.markdown", 0, 2, P, "12", 0), ("d.markdown", 0, 3, P, "words of a zero width", 0),
]
OPTION_ROWS = [("x.txt", 0, 0, P, "one", 0), ("x.txt", 0, 1, B, "", 0), ("x.txt", 0, 2, P, "two", 0), ("x.txt", 0, 3, B, "", 0), ("x.txt", 0, 4, P, "three", 0), ("y.txt", 0, 0, P, "one", 0), ("y.txt", 0, 1, P, "two", 0)]


def planted_text(spark: SparkSession, d: str) -> DataFrame:
    return _blocks(spark, TEXTS)


def planted_options(spark: SparkSession, d: str) -> DataFrame:
    """Bare numbers and lone dashes part scenes, page numbers fall away, where that is asked for."""
    parted = _blocks(spark, {"x.txt": b"one\n\n--\n\ntwo\n\n17\n\nthree"}, aggressive=True, numbered=True)
    return parted.unionByName(_blocks(spark, {"y.txt": b"one\n\nPage 3 of 9\n\n12\n\ntwo"}, strip_pages=True))


# HTML ----------------------------------------------------------------------
PAGES = {
    "a.html": "<html><head><title>no</title></head><body><h1>One</h1><h4>Sub</h4><p>a <b>b</b>c</p><p>line one<br/>line two<BR>* * *</p><hr/><div class='scene-break'></div><div class='x'></div></body></html>",
    "b.htm": "<p class='chapter-title'>Chapter 1</p><p align='center'><font size='6'>EMBER</font></p><p align='center'>This one ends in a mark.</p><div><p>x y</p><div><p>z w</p></div></div>bare text<script>no</script><nav><p>no</p></nav>",
    "c.xhtml": "<p>one<p>two<ul><li>a1<li>b1</ul><table><tr><td>a</td><td>b</td></tr></table><h2></h2><p> </p>",
}
PAGE_ROWS = [
    ("a.html", 0, 0, H, "One", 1), ("a.html", 0, 1, H, "Sub", 2), ("a.html", 0, 2, P, "a b c", 0), ("a.html", 0, 3, P, "line one", 0), ("a.html", 0, 4, P, "line two", 0), ("a.html", 0, 5, B, "", 0), ("a.html", 0, 6, B, "", 0), ("a.html", 0, 7, B, "", 0),
    ("b.htm", 0, 0, H, "Chapter 1", 1), ("b.htm", 0, 1, H, "EMBER", 1), ("b.htm", 0, 2, P, "This one ends in a mark.", 0), ("b.htm", 0, 3, P, "x y", 0), ("b.htm", 0, 4, P, "z w", 0), ("b.htm", 0, 5, P, "bare text", 0),
    ("c.xhtml", 0, 0, P, "one", 0), ("c.xhtml", 0, 1, P, "two", 0), ("c.xhtml", 0, 2, P, "a1", 0), ("c.xhtml", 0, 3, P, "b1", 0), ("c.xhtml", 0, 4, P, "a b", 0),
]


def planted_html(spark: SparkSession, d: str) -> DataFrame:
    return _blocks(spark, {k: v.encode() for k, v in PAGES.items()})


# EPUB ----------------------------------------------------------------------
_WORDS = "<p>some words here</p>"


def _epubs() -> dict[str, bytes]:
    plain = demo.epub({"ch1.xhtml": "<h2>One</h2><p>first text</p>", "cover.xhtml": "<p>no</p>", "ch2.xhtml": "<h2>Two</h2><hr/><p>second text</p>"}, "A Book.", nav=True)
    return {"plain.epub": plain}


EPUB_ROWS = [("plain.epub", 0, 0, H, "One", 1), ("plain.epub", 0, 1, P, "first text", 0), ("plain.epub", 0, 2, H, "Two", 1), ("plain.epub", 0, 3, B, "", 0), ("plain.epub", 0, 4, P, "second text", 0)]


def planted_epub(spark: SparkSession, d: str) -> DataFrame:
    return _blocks(spark, _epubs())


def _epub_sets() -> dict[str, bytes]:
    kids = [f"Chapter {i}" for i in range(6)]
    isbn = {f"978141699{b:04}_ch{i}.html": _WORDS for b in (1, 2) for i in range(3)}
    by_isbn = demo.nav_points([("Sea of Glass", "9781416990001_ch0.html", ["a", "b"]), ("About the Author", "9781416990002_ch2.html", []), ("Second Sea", "9781416990002_ch0.html", ["a"])])
    folders = {"title.html": _WORDS} | {f"{b}/c{i}.html": _WORDS for b in (1, 2) for i in range(6)}
    labelled = demo.nav_points([("Book One", "1/c0.html", ["Gold Hill", *kids]), ("Book Two: Far Away", "2/c0.html", kids)])
    named = demo.nav_points([("Gold", "1/c0.html", kids), ("Silver", "2/c0.html", kids)])
    return {
        "isbn.epub": demo.epub(isbn, "Two Seas", by_isbn), "labels.epub": demo.epub(folders, "Hills", labelled), "hint.epub": demo.epub(folders, "The Boxed Set", named), "no_hint.epub": demo.epub(folders, "Metals", named),
    }


EPUB_SET_ROWS = [
    ("isbn.epub", 0, 2, "Sea of Glass", "1", 3, "some words here"), ("isbn.epub", 1, 2, "Second Sea", "2", 3, "some words here"), ("labels.epub", 0, 2, "Gold Hill", "1", 7, "some words here"), ("labels.epub", 1, 2, "Far Away", "2", 6, "some words here"),
    ("hint.epub", 0, 2, "Gold", "1", 7, "some words here"), ("hint.epub", 1, 2, "Silver", "2", 6, "some words here"), ("no_hint.epub", 0, 1, "Metals", "", 13, "some words here"),
]


def planted_epub_sets(spark: SparkSession, d: str) -> DataFrame:
    return _sets(spark, _epub_sets())


def planted_epub_whole(spark: SparkSession, d: str) -> DataFrame:
    """The same collections when they are to stay whole."""
    return _sets(spark, _epub_sets(), split_omnibus=False)


EPUB_WHOLE_ROWS = [("isbn.epub", 0, 1, "Two Seas", "", 6, "some words here"), ("labels.epub", 0, 1, "Hills", "", 13, "some words here"), ("hint.epub", 0, 1, "The Boxed Set", "", 13, "some words here"), ("no_hint.epub", 0, 1, "Metals", "", 13, "some words here")]


# DOCX ----------------------------------------------------------------------
def planted_docx(spark: SparkSession, d: str) -> DataFrame:
    return _blocks(spark, {"w.docx": demo.docx([("H1", "The Start"), (None, "plain words"), (None, "* * *"), (None, "Chapter 2"), ("H3", "Sub"), ("Title", "T"), (None, " ")], "My Book.")})


DOCX_ROWS = [("w.docx", 0, 0, H, "The Start", 1), ("w.docx", 0, 1, P, "plain words", 0), ("w.docx", 0, 2, B, "", 0), ("w.docx", 0, 3, H, "Chapter 2", 1), ("w.docx", 0, 4, H, "Sub", 2), ("w.docx", 0, 5, H, "T", 1)]


# Kindle --------------------------------------------------------------------
def _kindles() -> dict[str, bytes]:
    html = "<html><body><h1>One</h1><p>café text</p><img></body></html>".encode()
    return {
        "plain.mobi": demo.mobi(html, author="Ann", trailing=0b10), "packed.azw": demo.mobi(html, "Packed", 2), "old.prc": demo.mobi("<p>œuvre ici</p>".encode("cp1252"), "Old", codepage=1252),
    }


KINDLE_ROWS = [("plain.mobi", 0, 0, H, "One", 1), ("plain.mobi", 0, 1, P, "café text", 0), ("packed.azw", 0, 0, H, "One", 1), ("packed.azw", 0, 1, P, "café text", 0), ("old.prc", 0, 0, P, "œuvre ici", 0)]


def planted_kindle(spark: SparkSession, d: str) -> DataFrame:
    return _blocks(spark, _kindles())


HEADER_ROWS = [("plain.mobi", "A Kindle Book", "Ann", "6", "1"), ("packed.azw", "Packed", "", "6", "2"), ("old.prc", "Old", "", "6", "1")]


def planted_kindle_headers(spark: SparkSession, d: str) -> DataFrame:
    names = {"title": "full_name", "author": "author", "mobi_version": "version", "compression": "compression"}
    return _documents(spark, _kindles()).select("rel", *[F.coalesce(F.col("meta")[k], F.lit("")).alias(v) for k, v in names.items()])


def _kindle_set() -> bytes:
    book = lambda title: f"<p>{title}</p><p>Contents</p>".encode() + b"<p>some words</p>" * 4000
    one, two = book("First"), book("Second")
    links = b"<a filepos=%010d>First</a><a filepos=%010d>Second</a>"
    base = len(links % (0, 0))
    return links % (base, base + len(one)) + one + two


KINDLE_SET_ROWS = [("set.mobi", 0, 2, "First", "1", 4004, "First"), ("set.mobi", 1, 2, "Second", "2", 4002, "Second")]


def planted_kindle_sets(spark: SparkSession, d: str) -> DataFrame:
    return _sets(spark, {"set.mobi": demo.mobi(_kindle_set(), "Both")})


PACKED = [("a", "0261628010"), ("b", "0161"), ("c", "c1"), ("d", "0041"), ("e", "80"), ("f", "0261628008")]
UNPACKED_ROWS = [("a", "6162616261"), ("b", "61"), ("c", "2041"), ("d", "0041"), ("e", ""), ("f", "6162626262")]


def planted_unpacked(spark: SparkSession, d: str) -> DataFrame:
    """Records of the byte-pair scheme: literals, a reference, a blank with a letter."""
    from quire.sources.kindle import decompress

    rows = [(name, decompress(bytes.fromhex(code)).hex()) for name, code in PACKED]
    return spark.createDataFrame(rows, "name string, bytes string")


TRAILED = [("none", "74657874", 0), ("entry", "7465787481", 2), ("letter", "7465787400", 1), ("both", "7465787401616283", 3), ("whole", "81", 2)]
TRAILED_ROWS = [("none", "74657874"), ("entry", "74657874"), ("letter", "74657874"), ("both", "746578"), ("whole", "81")]


def planted_trailing(spark: SparkSession, d: str) -> DataFrame:
    """Records without the entries behind their text."""
    from quire.sources.kindle import strip_trailing

    return spark.createDataFrame([(name, strip_trailing(bytes.fromhex(code), flags).hex()) for name, code, flags in TRAILED], "name string, bytes string")


# Errors, listing, manifest, books -------------------------------------------
def planted_errors(spark: SparkSession, d: str) -> DataFrame:
    """Files that cannot be read give an error row each and end nothing."""
    html = b"<p>text</p>"
    bad = {"a.pdf": b"%PDF", "b.xyz": b"", "c.mobi": b"\0" * 90, "d.mobi": demo.mobi(html, encryption=2), "e.azw3": demo.mobi(html, version=8), "f.mobi": demo.mobi(html, compression=7), "g.docx": b"no archive", "h.txt": b"fine"}
    return _documents(spark, bad).select("rel", "n_docs", F.coalesce(F.regexp_extract("error", r"^(\w+):", 1), F.lit("")).alias("error"))


ERROR_ROWS = [("a.pdf", 0, "ValueError"), ("b.xyz", 0, "ValueError"), ("c.mobi", 0, "KindleError"), ("d.mobi", 0, "KindleError"), ("e.azw3", 0, "KindleError"), ("f.mobi", 0, "KindleError"), ("g.docx", 0, "BadZipFile"), ("h.txt", 1, "")]
LISTED = ["sea/One.EPUB", "sea/deep/Two Parts.md", "tale.txt", "shelf/Book.txt", "shelf/Book.md", ".hidden.txt", "sea/~$lock.docx", "__MACOSX/x.txt", "sea/__MACOSX/y.txt", "cover.jpg", "notes", "k.azw3"]


def planted_listing(spark: SparkSession, d: str) -> DataFrame:
    """Books of a listing: one a file, two files with one id told apart, the top folder as series."""
    listing = spark.createDataFrame([(f"file:/lib/{p}", 1) for p in LISTED], "path string, length long")
    return sources.discover_books(sources.usable(listing, "file:/lib")).select("book_id", "title", "series", "group_key", "order_hint", F.element_at("sources", 1).alias("source"))


LISTING_ROWS = [
    ("k", "k", "_root", "_root", 0, "k.azw3"), ("sea_one", "One", "sea", "sea", 1, "sea/One.EPUB"), ("sea_deep_two_parts", "Two Parts", "sea", "sea", 2, "sea/deep/Two Parts.md"), ("shelf_book", "Book", "shelf", "shelf", 3, "shelf/Book.md"),
    ("shelf_book-2", "Book", "shelf", "shelf", 4, "shelf/Book.txt"), ("tale", "tale", "_root", "_root", 5, "tale.txt"),
]
MANIFEST = "books:\n  - {id: mix, title: Mix, sources: [a.txt, b.txt]}\n  - {id: solo, sources: [c.txt], series: Sea, order: 7}\n  - {id: grouped, sources: [d.txt], series: Sea, group: G}\n"


def planted_manifest(spark: SparkSession, d: str) -> DataFrame:
    return sources.manifest_books(spark, MANIFEST).select("book_id", "title", F.coalesce("series", F.lit("")).alias("series"), "group_key", "order_hint", F.array_join("sources", ",").alias("sources"))


MANIFEST_ROWS = [("mix", "Mix", "", "mix", 0, "a.txt,b.txt"), ("solo", "solo", "Sea", "Sea", 7, "c.txt"), ("grouped", "grouped", "Sea", "G", 2, "d.txt")]


def _assembled(spark: SparkSession) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Two sources of one book, a collection of two novels with one title, one id twice, a missing and an empty file."""
    kids = [str(i) for i in range(6)]
    novels = demo.epub({f"{b}/c{i}.html": f"<p>novel {b}</p>" for b in (1, 2) for i in range(6)}, "Two", demo.nav_points([("Book One - Sea", "1/c0.html", kids), ("Book Two - Sea", "2/c0.html", kids)]))
    files = {"a.txt": b"from a", "b.txt": b"# B\n\nfrom b", "two.epub": novels, "one.md": b"first", "one.txt": b"second", "blank.txt": b"# Only a heading", "bad.pdf": b""}
    specs = [("mix", "Mix", "S", 0, ["a.txt", "b.txt"]), ("two", "Two", None, 1, ["two.epub"]), ("one", "One", None, 2, ["one.md"]), ("one-2", "One", None, 3, ["one.txt"]), ("blank", "Blank", None, 4, ["blank.txt"]), ("bad", "Bad", None, 5, ["a.txt", "bad.pdf"]), ("gone", "Gone", None, 6, ["gone.txt"])]
    rows = spark.createDataFrame(specs, "book_id string, title string, series string, order_hint int, sources array<string>")
    books, blocks, errors = sources.assemble_books(rows, _documents(spark, files))
    structure.require_unique(blocks)
    tree = structure.hierarchy(blocks)
    books, errors = sources.without_prose(books, tree, errors)
    return books, tree, errors


def planted_books(spark: SparkSession, d: str) -> DataFrame:
    books, tree, _ = _assembled(spark)
    text = tree.where("kind = 'paragraph'").groupBy("book_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("block_ord", "text"))), lambda x: x["text"]), "|").alias("text"))
    return books.join(text, "book_id").select("book_id", "title", "order_hint", F.array_join("source_files", ",").alias("sources"), "text")


BOOK_ROWS = [
    ("mix", "Mix", 0, "a.txt,b.txt", "from a|from b"), ("two__sea", "Sea", 101, "two.epub", "|".join(["novel 1"] * 6)), ("two__sea-2", "Sea", 102, "two.epub", "|".join(["novel 2"] * 6)), ("one", "one", 2, "one.md", "first"), ("one-2", "one", 3, "one.txt", "second"),
]


def planted_book_errors(spark: SparkSession, d: str) -> DataFrame:
    return _assembled(spark)[2].select("book_id", F.regexp_extract("error", r"^(\w+)", 1).alias("error"), F.array_join("sources", ",").alias("sources"))


BOOK_ERROR_ROWS = [("bad", "ValueError", "bad.pdf"), ("gone", "missing", "gone.txt"), ("blank", "no", "blank.txt")]

# Packing ---------------------------------------------------------------------
# A word alone costs 1, two 2, three 3, four 5, five 6, six 7, seven 9, eight 10, ten 13, twelve 15, fifteen 19, sixteen 20; a separator costs nothing.
PACK = packing.PackConfig(max_seq_len=22)


def _w(n: int, letter: str) -> str:
    return " ".join([letter] * n)


#: Book -> (kind, level, text) in order.
PACK_BOOKS = {
    # two scenes that share a chunk across a chapter's end, and a third that opens the next
    "share": [(H, 1, "One"), (P, 0, _w(4, "a")), (B, 0, ""), (P, 0, _w(4, "b")), (H, 1, "Two"), (P, 0, _w(6, "c"))],
    # a scene is not cut to fill what is left
    "whole": [(P, 0, _w(10, "a")), (B, 0, ""), (P, 0, _w(5, "b")), (P, 0, _w(5, "c"))],
    # a scene over the budget is cut between paragraphs; its last piece is closed, headings ride with the first
    "cut": [(H, 1, "T"), (H, 2, "S"), (P, 0, _w(10, "a")), (P, 0, _w(10, "b")), (P, 0, _w(10, "c")), (B, 0, ""), (P, 0, _w(2, "d"))],
    # a paragraph over the budget goes to the ledger and leaves a gap
    "dear": [(P, 0, _w(3, "a")), (P, 0, _w(20, "b")), (P, 0, _w(3, "c"))],
    # prices that add up to 20 but count 26 together: the last two paragraphs wait
    "exact": [(P, 0, _w(2, "a")), (P, 0, _w(2, "b")), (P, 0, _w(2, "c")), (P, 0, _w(2, "d")), (P, 0, _w(2, "e")), (P, 0, _w(2, "f")), (P, 0, _w(2, "g")), (P, 0, _w(2, "h")), (P, 0, _w(2, "i")), (P, 0, _w(2, "j"))],
    # a title line over the budget cannot be placed
    "title": [(H, 1, _w(30, "t")), (P, 0, _w(3, "a"))],
}


def _pack_books(spark: SparkSession, cfg: packing.PackConfig) -> tuple[DataFrame, DataFrame]:
    rows = [(b, i, k, t, lv) for b, items in PACK_BOOKS.items() for i, (k, lv, t) in enumerate(items)]
    tree = structure.hierarchy(spark.createDataFrame(rows, "book_id string, block_ord long, kind string, text string, level int"))
    books = spark.createDataFrame([(b, b.title(), [f"{b}.txt"]) for b in PACK_BOOKS], "book_id string, title string, source_files array<string>")
    return packing.pack(tree, books, cfg)


def _chunk_columns(chunks: DataFrame) -> DataFrame:
    flag = lambda f, c: F.when(F.col(f"flags.{f}"), c).otherwise("")
    flags = F.concat(flag("starts_chapter", "C"), flag("starts_scene", "S"), flag("ends_scene", "E"), flag("continues_scene", "R"), flag("spans_multiple_scenes", "M"))
    return chunks.select(
        "id", F.replace("text", F.lit("\n\n"), F.lit("/")).alias("text"), "n_tokens", F.concat_ws("-", "chapter_index", "chapter_index_end").alias("chapters"), F.coalesce("chapter_title", F.lit("")).alias("chapter_title"),
        F.concat_ws("-", "scene_index_start", "scene_index_end").alias("scenes"), F.concat_ws("-", "paragraph_index_start", "paragraph_index_end").alias("paragraphs"), "n_paragraphs",
        F.array_join(F.col("paragraph_index_gaps").cast("array<string>"), ",").alias("gaps"), "order_in_book", flags.alias("flags"), "book_title", F.element_at("source_files", 1).alias("source"),
    )


def planted_pack(spark: SparkSession, d: str) -> DataFrame:
    return _chunk_columns(_pack_books(spark, PACK)[0])


def _ledger_columns(over: DataFrame) -> DataFrame:
    return over.select("book_id", "kind", F.coalesce("scene", F.lit(-1)).alias("scene"), F.coalesce("paragraph", F.lit(-1)).alias("paragraph"), "n_tokens", "budget", "action", F.coalesce("n_paragraphs", F.lit(-1)).alias("n_paragraphs"), F.coalesce(F.array_join("chunk_ids", ","), F.lit("")).alias("chunk_ids"), F.coalesce("source", F.lit("")).alias("source"))


def planted_ledger(spark: SparkSession, d: str) -> DataFrame:
    return _ledger_columns(_pack_books(spark, PACK)[1])


def planted_ledger_kinds(spark: SparkSession, d: str) -> DataFrame:
    return stats.oversize_by_kind(_pack_books(spark, PACK)[1]).select("kind", "n", "n_tokens", F.to_json("actions").alias("actions"))


def planted_excluded(spark: SparkSession, d: str) -> DataFrame:
    """Chunks when scenes over the budget are left out whole."""
    return _pack_books(spark, packing.PackConfig(max_seq_len=22, oversize="exclude"))[0].where("book_id in ('cut', 'dear', 'title')").select("id", F.replace("text", F.lit("\n\n"), F.lit("/")).alias("text"), "order_in_book")


def planted_merged(spark: SparkSession, d: str) -> DataFrame:
    """Small chunks joined to the one before them, within the chapter; ids keep their numbers."""
    return _chunk_columns(_pack_books(spark, packing.PackConfig(max_seq_len=22, min_tokens=10))[0]).where("id like 'exact%' or id like 'whole%' or id like 'cut%'").select("id", "text", "n_tokens", "order_in_book", "flags")


# A whole build ----------------------------------------------------------------
LIBRARY = {
    "s/one.txt": f"Chapter One\n\n{_w(4, 'a')}\n\n{_w(4, 'b')}\n\n* * *\n\n{_w(6, 'c')}".encode(), "s/two.md": f"# T\n\n{_w(20, 'x')}\n\nd d".encode(), "out/x.txt": b"words", "bad.mobi": b"\0" * 90, "empty.txt": b"# Only",
}


def planted_build(spark: SparkSession, d: str) -> DataFrame:
    """Figures of a build of five files, of the files it writes, and exit codes of the command line."""
    from quire import cli
    from quire.plans.build import BuildConfig, run_build, write_outputs

    root = Path(urlparse(_folder(spark)).path)
    try:
        for name, content in LIBRARY.items():
            (root / "raw" / name).parent.mkdir(parents=True, exist_ok=True)
            (root / "raw" / name).write_bytes(content)
        (root / "recipe.yaml").write_text("budget: [1")
        cfg = BuildConfig(raw_root=str(root / "raw"), out_root=str(root / "out"), max_seq_len=22, exclude_patterns=("out*",), split_by="none")
        result = run_build(spark, cfg)
        out = write_outputs(cfg, result)
        lines = {f"{n}_lines": len((out / f"{n}.jsonl").read_text().splitlines()) for n in ("chunks", "train", "val", "oversize_blocks")}
        st = result.stats
        figures = {
            **{k: st["corpus"][k] for k in ("books_included", "books_excluded", "books_total", "chapters", "scenes", "paragraphs", "words")},
            **{k: st["dataset"][k] for k in ("chunks", "content_tokens", "boundary_tokens", "training_tokens_including_boundaries", "train_chunks", "val_chunks", "budget_utilisation")},
            **{k: st["boundaries"][k] for k in ("chunks_opening_a_chapter", "chunks_ending_on_a_scene", "chunks_resuming_a_scene", "pct_ending_on_a_scene")},
            **{k: st["oversize"][k] for k in ("records", "excluded_tokens", "excluded_fraction", "review_required", "stop")}, "errors": len(st["errors"]), "books_in_provenance": len(st["provenance"]["books"]), **lines,
        }
        base = ["--raw-root", cfg.raw_root, "--out-root", str(root / "cli"), "--max-seq-len", "22", "--exclude", "out*"]
        with contextlib.redirect_stdout(io.StringIO()), contextlib.redirect_stderr(io.StringIO()):
            codes = {"exit_gate": cli.main(base), "exit_dry_run": cli.main([*base, "--dry-run"]), "exit_recipe": cli.main([*base, "--config", str(root / "recipe.yaml")]), "exit_no_root": cli.main(["--raw-root", str(root / "nowhere")])}
        return spark.createDataFrame([(k, float(v)) for k, v in {**figures, **codes}.items()], "name string, value double")
    finally:
        shutil.rmtree(root, ignore_errors=True)


BUILD_ROWS = [
    ("books_included", 2.0), ("books_excluded", 1.0), ("books_total", 3.0), ("chapters", 2.0), ("scenes", 3.0), ("paragraphs", 5.0), ("words", 36.0), ("chunks", 2.0), ("content_tokens", 23.0), ("boundary_tokens", 4.0),
    ("training_tokens_including_boundaries", 27.0), ("train_chunks", 2.0), ("val_chunks", 0.0), ("budget_utilisation", 0.575), ("chunks_opening_a_chapter", 2.0), ("chunks_ending_on_a_scene", 2.0), ("chunks_resuming_a_scene", 0.0),
    ("pct_ending_on_a_scene", 100.0), ("records", 2.0), ("excluded_tokens", 26.0), ("excluded_fraction", 0.530612), ("review_required", 1.0), ("stop", 1.0), ("errors", 2.0), ("books_in_provenance", 2.0), ("chunks_lines", 2.0), ("train_lines", 2.0),
    ("val_lines", 0.0), ("oversize_blocks_lines", 2.0), ("exit_gate", 3.0), ("exit_dry_run", 0.0), ("exit_recipe", 2.0), ("exit_no_root", 2.0),
]


# Sinks -----------------------------------------------------------------------
def _folder(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/sink-{uuid.uuid4().hex}"


def sink_lines(spark: SparkSession, d: str) -> DataFrame:
    """Chunks written as JSON lines in a folder of part files and read again."""
    to = _folder(spark)
    chunks = read_table(spark, d, "chunks").dropDuplicates(["id"]).select("id", "text", "n_tokens", "book_id", "order_in_book")
    sinks.write_jsonl(chunks, to, ["book_id", "order_in_book"])
    return spark.read.schema("id string, text string, n_tokens int, book_id string").json(to).select("id", "book_id", "n_tokens", F.char_length("text").alias("n_chars"))


def sink_dataset(spark: SparkSession, d: str) -> DataFrame:
    """Chunks written as Parquet by split and read again."""
    to = _folder(spark)
    chunks = read_table(spark, d, "chunks").dropDuplicates(["id"]).select("id", "text", F.coalesce("n_tokens", F.lit(0)).alias("n_tokens"), "book_id", "chapter_index")
    sinks.write_dataset(splits.assign_splits(chunks, "chapter", 0.1), to)
    return spark.read.parquet(to).groupBy("split").agg(F.count("*").alias("n_chunks"), F.sum("n_tokens").alias("n_tokens"), F.countDistinct("book_id").alias("n_books"))


#: A vocabulary of single letters and two words, written where the stream is packed.
def _vocabulary(folder: Path) -> str:
    tokens = [bytes([i]) for i in range(256)] + [b"to", b"be", b" to", b" be"]
    path = folder / "letters.tiktoken"
    path.write_bytes(b"\n".join(base64.b64encode(t) + b" " + str(i).encode() for i, t in enumerate(tokens)))
    return str(path)


def _stream(spark: SparkSession, of: Callable[[DataFrame], DataFrame]) -> DataFrame:
    folder = Path(urlparse(_folder(spark)).path)
    folder.mkdir(parents=True)
    try:
        chunks = spark.createDataFrame([("b::0", "b", 0, "to be", "train"), ("a::1", "a", 1, "to", "train"), ("a::0", "a", 0, "be x", "train")], "id string, book_id string, order_in_book int, text string, split string")
        return cut_lineage(of(sinks.pack_stream(chunks, _vocabulary(folder), 300, 301, 8)))
    finally:
        shutil.rmtree(folder, ignore_errors=True)


def planted_stream(spark: SparkSession, d: str) -> DataFrame:
    """Token sequences with boundary tokens in the order of book and chunk, and where they lie in one stream."""
    return _stream(spark, lambda s: s.select("id", F.col("start").cast("long").alias("start"), F.col("end").cast("long").alias("end_at"), F.col("seq_len").cast("long").alias("seq_len"), F.array_join(F.col("ids").cast("array<string>"), ",").alias("ids")))


STREAM_ROWS = [("a::0", 0, 5, 5, "300,257,32,120,301"), ("a::1", 5, 8, 3, "300,256,301"), ("b::0", 8, 12, 4, "300,256,259,301")]


def planted_batches(spark: SparkSession, d: str) -> DataFrame:
    """Padded length, real tokens and labels of a batch."""
    batch = _stream(spark, lambda s: sinks.collate(s.select("id", "ids").withColumn("batch", F.lit(0)), "batch"))
    real = F.size(F.filter("labels", lambda x: x != -100))
    return batch.groupBy("batch").agg(F.count("*").alias("n"), F.max(F.size("input_ids")).alias("padded"), F.sum(F.aggregate("attention_mask", F.lit(0), lambda a, x: a + x.cast("int"))).alias("n_real"), F.sum(real).alias("n_labels"))


BATCH_ROWS = [(0, 3, 8, 12, 12)]


def excluded_share(spark: SparkSession, d: str) -> DataFrame:
    """Tokens of paragraphs dearer than 512 and their share of all."""
    p = read_table(spark, d, "paragraphs").groupBy("book_id", "paragraph_index").agg(F.max(proxy_tokens(F.col("text"))).alias("n_tokens"))
    kept = p.where("n_tokens <= 512")
    over = p.where("n_tokens > 512").select(F.lit("oversize_paragraph").alias("kind"), F.lit("excluded").alias("action"), "n_tokens")
    return stats.excluded_fraction(kept, over).select("excluded_tokens", F.round("fraction", 9).alias("fraction"))


def labels(spark: SparkSession, d: str) -> DataFrame:
    """Navigation labels and entry names."""
    rows = [("<b>Part</b>&nbsp;One", "OPS/ch1.xhtml"), ("> &#8220;Sea&#8221; &amp; sky ", "OPS/nav.xhtml"), ("&#8216;a&#8217;", "OPS/also-by.html"), ("", "copyright.htm"), (None, None)]
    t = spark.createDataFrame(rows, "label string, name string")
    return t.select(F.coalesce("label", F.lit("none")).alias("label"), F.coalesce(X.clean_label(F.col("label")), F.lit("none")).alias("cleaned"), X.is_skipped_part(F.col("name")).alias("skipped"))


LABEL_ROWS = [("<b>Part</b>&nbsp;One", "Part One", False), ("> &#8220;Sea&#8221; &amp; sky ", "“Sea” & sky", True), ("&#8216;a&#8217;", "‘a’", True), ("", "", True), ("none", "none", False)]


# Expected rows ---------------------------------------------------------------
_SPLIT = "split_at_paragraph_boundaries"
CHUNK_ROWS = [
    ("share::00000", f"One/{_w(4, 'a')}/{_w(4, 'b')}/Two/{_w(6, 'c')}", 20, "0-1", "Two", "0-1", "0-2", 3, "", 0, "CEM", "Share", "share.txt"),
    ("whole::00000", _w(10, "a"), 13, "0-0", "", "0-0", "0-0", 1, "", 0, "E", "Whole", "whole.txt"), ("whole::00001", f"{_w(5, 'b')}/{_w(5, 'c')}", 13, "0-0", "", "1-1", "1-2", 2, "", 1, "E", "Whole", "whole.txt"),
    ("cut::00000", f"T/S/{_w(10, 'a')}", 15, "0-0", "T", "0-0", "0-0", 1, "", 0, "C", "Cut", "cut.txt"), ("cut::00001", _w(10, "b"), 13, "0-0", "T", "0-0", "1-1", 1, "", 1, "R", "Cut", "cut.txt"),
    ("cut::00002", _w(10, "c"), 13, "0-0", "T", "0-0", "2-2", 1, "", 2, "ER", "Cut", "cut.txt"), ("cut::00003", "d d", 2, "0-0", "T", "1-1", "3-3", 1, "", 3, "E", "Cut", "cut.txt"),
    ("dear::00000", "a a a/c c c", 7, "0-0", "", "0-0", "0-2", 2, "1", 0, "E", "Dear", "dear.txt"),
    ("exact::00000", "a a/b b/c c/d d/e e/f f/g g/h h", 20, "0-0", "", "0-0", "0-7", 8, "", 0, "", "Exact", "exact.txt"), ("exact::00001", "i i/j j", 5, "0-0", "", "0-0", "8-9", 2, "", 1, "E", "Exact", "exact.txt"),
    ("title::00000", "a a a", 3, "0-0", _w(30, "t"), "0-0", "0-0", 1, "", 0, "E", "Title", "title.txt"),
]
LEDGER_ROWS = [
    ("cut", "oversize_scene", 0, -1, 40, 20, _SPLIT, 3, "cut::00000,cut::00001,cut::00002", "cut.txt"), ("dear", "oversize_paragraph", 0, 1, 26, 20, "excluded", -1, "", "dear.txt"), ("dear", "oversize_scene", 0, -1, 32, 20, _SPLIT, 3, "dear::00000", "dear.txt"),
    ("title", "oversize_heading", -1, -1, 39, 20, "excluded", -1, "", "title.txt"), ("title", "oversize_scene", 0, -1, 3, 20, _SPLIT, 1, "title::00000", "title.txt"),
]
LEDGER_KIND_ROWS = [("oversize_scene", 3, 75, f'{{"{_SPLIT}":3}}'), ("oversize_paragraph", 1, 26, '{"excluded":1}'), ("oversize_heading", 1, 39, '{"excluded":1}')]
MERGED_ROWS = [
    ("cut::00000", f"T/S/{_w(10, 'a')}", 15, 0, "C"), ("cut::00001", _w(10, "b"), 13, 1, "R"), ("cut::00002", f"{_w(10, 'c')}/d d", 15, 2, "ERM"), ("exact::00000", "a a/b b/c c/d d/e e/f f/g g/h h", 20, 0, ""), ("exact::00001", "i i/j j", 5, 1, "E"),
    ("whole::00000", _w(10, "a"), 13, 0, "E"), ("whole::00001", f"{_w(5, 'b')}/{_w(5, 'c')}", 13, 1, "E"),
]
_BLOCK = "rel, doc_ord int, block_ord int, kind, text, level int"
_SET = "rel, doc_ord int, n_docs int, title, part, n_blocks int, first"
_CHUNK = "id, text, n_tokens int, chapters, chapter_title, scenes, paragraphs, n_paragraphs int, gaps, order_in_book int, flags, book_title, source"
#: Query -> (columns, rows it must give).
EXPECTED: dict[str, tuple[str, list[tuple]]] = {
    "planted_text": (_BLOCK, TEXT_ROWS), "planted_options": (_BLOCK, OPTION_ROWS), "planted_html": (_BLOCK, PAGE_ROWS), "planted_epub": (_BLOCK, EPUB_ROWS), "planted_epub_sets": (_SET, EPUB_SET_ROWS), "planted_epub_whole": (_SET, EPUB_WHOLE_ROWS),
    "planted_docx": (_BLOCK, DOCX_ROWS), "planted_kindle": (_BLOCK, KINDLE_ROWS), "planted_kindle_headers": ("rel, full_name, author, version, compression", HEADER_ROWS), "planted_kindle_sets": (_SET, KINDLE_SET_ROWS),
    "planted_unpacked": ("name, bytes", UNPACKED_ROWS), "planted_trailing": ("name, bytes", TRAILED_ROWS), "planted_errors": ("rel, n_docs int, error", ERROR_ROWS), "planted_listing": ("book_id, title, series, group_key, order_hint int, source", LISTING_ROWS),
    "planted_manifest": ("book_id, title, series, group_key, order_hint int, sources", MANIFEST_ROWS), "planted_books": ("book_id, title, order_hint int, sources, text", BOOK_ROWS), "planted_book_errors": ("book_id, error, sources", BOOK_ERROR_ROWS),
    "planted_pack": (_CHUNK, CHUNK_ROWS), "planted_ledger": ("book_id, kind, scene int, paragraph int, n_tokens int, budget int, action, n_paragraphs int, chunk_ids, source", LEDGER_ROWS), "planted_ledger_kinds": ("kind, n bigint, n_tokens bigint, actions", LEDGER_KIND_ROWS),
    "planted_excluded": ("id, text, order_in_book int", [("cut::00000", "d d", 0)]), "planted_merged": ("id, text, n_tokens int, order_in_book int, flags", MERGED_ROWS), "labels": ("label, cleaned, skipped boolean", LABEL_ROWS), "planted_build": ("name, value double", BUILD_ROWS), "planted_stream": ("id, start bigint, end_at bigint, seq_len bigint, ids", STREAM_ROWS),
    "planted_batches": ("batch int, n bigint, padded int, n_real bigint, n_labels bigint", BATCH_ROWS),
}


def _values(columns: str, rows: list[tuple]) -> str:
    """Rows as a statement."""
    typed = [(c.split() + ["varchar"])[:2] for c in columns.split(", ")]
    quote = lambda v: "'" + v.replace("'", "''") + "'" if isinstance(v, str) else str(v)
    body = ", ".join("(" + ", ".join(map(quote, r)) + ")" for r in rows)
    return f"SELECT {', '.join(f'{c}::{t} AS {c}' for c, t in typed)} FROM (VALUES {body}) t({', '.join(c for c, _ in typed)})"


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """Name -> query; what it gives does not hang on the folder, but for the sinks."""
    return {name: globals()[name] for name in EXPECTED} | {"sink_lines": sink_lines, "sink_dataset": sink_dataset, "excluded_share": excluded_share}


def oracle_sql(chunks: str, tokens: Callable[[str], str], unit: str) -> dict[str, str]:
    """Name -> DuckDB statement; chunks, tokens and unit: a chunk once, the price of a text, the stable number of a key, all in SQL."""
    price = f"SELECT book_id, paragraph_index, max({tokens('text')}) AS n FROM paragraphs GROUP BY 1, 2"
    return {name: _values(*e) for name, e in EXPECTED.items()} | {
        "sink_lines": f"SELECT id, book_id, n_tokens, len(text)::INTEGER AS n_chars FROM {chunks}",
        "sink_dataset": f"SELECT CASE WHEN {unit.format(chr(40) + 'book_id || ' + repr('::') + ' || chapter_index' + chr(41))} < 0.1::DOUBLE THEN 'val' ELSE 'train' END AS split, count(*) AS n_chunks, sum(coalesce(n_tokens, 0))::BIGINT AS n_tokens, count(DISTINCT book_id) AS n_books FROM {chunks} GROUP BY 1",
        "excluded_share": f"SELECT coalesce(sum(n) FILTER (n > 512), 0)::BIGINT AS excluded_tokens, round(round(sum(n) FILTER (n > 512) / sum(n)::DOUBLE, 6), 9) AS fraction FROM ({price})",
    }
