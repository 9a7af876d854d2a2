"""File discovery, exclusion, and the extraction of blocks from file contents."""

from __future__ import annotations

import re
from collections.abc import Iterator
from pathlib import PurePosixPath
from urllib.parse import unquote

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quire.functions import text as X
from quire.operators.running import global_running_sum
from quire.plans.session import cut_lineage

#: Suffixes by reader.
TEXT, HTML, EPUB, WORD, KINDLE = ("txt", "md", "markdown"), ("html", "htm", "xhtml"), ("epub",), ("docx",), ("mobi", "azw", "azw3", "prc")
SUFFIXES = (*EPUB, *KINDLE, *TEXT, *WORD, *HTML)


def list_files(spark: SparkSession, root: str, suffixes: tuple[str, ...] = SUFFIXES, recursive: bool = True) -> DataFrame:
    """path, rel, name, suffix, length of the usable files below root. Only the listing is read, no contents."""
    base = root.rstrip("/")
    listing = spark.read.format("binaryFile").option("recursiveFileLookup", str(recursive).lower()).load(base).select("path", "length")
    return usable(listing, base if "://" in base else "file:" + base, suffixes)


def usable(listing: DataFrame, base: str, suffixes: tuple[str, ...] = SUFFIXES) -> DataFrame:
    """path, rel, name, suffix, length of a listing's files (path, length) below base, hidden, locked and resource files left out."""
    rel = F.regexp_replace(F.regexp_replace(F.col("path"), r"^[a-z]+:/*", "/"), "^" + re.escape(re.sub(r"^[a-z]+:/*", "/", base)) + "/?", "")
    f = listing.withColumn("rel", rel).withColumn("name", F.element_at(F.split("rel", "/"), -1)).withColumn("suffix", F.lower(F.regexp_extract("name", r"\.([^.]+)$", 1)))
    return f.where(F.col("suffix").isin(list(suffixes)) & ~F.col("name").startswith(".") & ~F.col("name").startswith("~$") & ~F.array_contains(F.split("rel", "/"), "__MACOSX"))


def distinct_ids(rows: DataFrame, order: list[str], column: str = "book_id") -> DataFrame:
    """rows whose equal ids are told apart: the second gets "-2" behind it, and so on. Slugs have no hyphens, so no other slug is met."""
    nth = F.row_number().over(W.partitionBy(column).orderBy(*order))
    return rows.withColumn(column, F.when(nth == 1, F.col(column)).otherwise(F.concat_ws("-", column, nth)))


def discover_books(files: DataFrame) -> DataFrame:
    """book_id, title, author, series, group_key, order_hint, sources: each file is a book, its top folder the series.

    Files whose paths give one id (Book.txt, Book.md) are numbered in the order of their paths.
    """
    stem = F.regexp_replace("name", r"\.[^.]+$", "")
    folder = F.regexp_replace("rel", r"/?[^/]*$", "")
    top = F.when(folder == "", "_root").otherwise(F.split("rel", "/")[0])
    named = files.select(
        "rel", X.slugify(F.concat_ws("/", F.when(folder != "", folder), stem)).alias("book_id"), stem.alias("title"), F.lit(None).cast("string").alias("author"), top.alias("series"), top.alias("group_key"), F.lit(1).alias("one"),
    )
    ranked = global_running_sum(distinct_ids(named, ["rel"]), ["rel"], "one", "rank")
    return ranked.select("book_id", "title", "author", "series", "group_key", (F.col("rank") - 1).cast("int").alias("order_hint"), F.array("rel").alias("sources"))


def load_manifest(spark: SparkSession, path: str, files: DataFrame | None = None) -> DataFrame:
    """Books as a YAML manifest declares them; missing files raise. The group defaults to the series, then to the id."""
    with open(path, encoding="utf-8") as f:
        return manifest_books(spark, f.read(), files)


def manifest_books(spark: SparkSession, text: str, files: DataFrame | None = None) -> DataFrame:
    """The books of a manifest's text."""
    import yaml

    try:
        tree = yaml.safe_load(text) or {}
    except yaml.YAMLError as e:
        raise ValueError(f"manifest: {e}") from e
    entries = (tree.get("books") if isinstance(tree, dict) else None) or []
    if not isinstance(entries, list):
        raise ValueError("books must be a list")
    rows = []
    for i, e in enumerate(entries):
        if not isinstance(e, dict) or not e.get("id") or not e.get("sources"):
            raise ValueError(f"book {i} needs an id and sources")
        group = e.get("group") or e.get("series") or e["id"]
        rows.append((str(e["id"]), str(e.get("title") or e["id"]), None, e.get("series") and str(e["series"]), str(group), int(e.get("order", i)), [str(s) for s in e["sources"]]))
    ids = [r[0] for r in rows]
    if len(set(ids)) < len(ids):
        raise ValueError(f"ids that name two books: {sorted({i for i in ids if ids.count(i) > 1})}")
    books = spark.createDataFrame(rows, "book_id string, title string, author string, series string, group_key string, order_hint int, sources array<string>")
    if files is not None:
        wanted = books.select(F.explode("sources").alias("rel")).distinct()
        missing = [r["rel"] for r in wanted.join(files.select("rel"), "rel", "left_anti").orderBy("rel").limit(20).collect()]
        if missing:
            raise FileNotFoundError(f"missing sources: {', '.join(missing)}")
    return books


def mark_excluded(books: DataFrame, patterns: list[str]) -> DataFrame:
    """books with matched_pattern, the first pattern that fits the id, title, series, group or a source; null for kept books.

    The patterns are a short list of the configuration, folded into one expression; nothing is joined.
    """
    src = F.coalesce("sources", F.array().cast("array<string>"))
    names = F.transform(src, lambda s: F.element_at(F.split(s, "/"), -1))
    stems = F.transform(names, lambda n: F.regexp_replace(n, r"\.[^.]+$", ""))
    parents = F.transform(src, lambda s: F.coalesce(F.try_element_at(F.split(s, "/"), F.lit(-2)), F.lit("")))
    fields = F.filter(F.concat(F.array("book_id", "title", "series", "group_key"), names, stems, parents), lambda x: F.coalesce(x, F.lit("")) != "")
    hit = F.lit(None).cast("string")
    for p in reversed(patterns):
        rule = X.glob_to_regex(p.lower())
        hit = F.when(F.exists(fields, lambda x: F.lower(x).rlike(rule)), F.lit(p)).otherwise(hit)  # noqa: B023, used at once
    return books.withColumn("matched_pattern", hit)


def extract_documents(name: str, data: bytes, aggressive: bool = False, numbered: bool = False, strip_pages: bool = False, split_omnibus: bool = True):
    """Documents of one file by its suffix; raises for what cannot be read."""
    from quire.functions.pytext import decode_text, text_blocks
    from quire.sources.archives import Document, docx_document, epub_documents
    from quire.sources.kindle import kindle_documents
    from quire.sources.markup import html_blocks

    p = PurePosixPath(name)
    suffix, stem = p.suffix.lower().lstrip("."), p.stem
    if suffix in EPUB:
        return epub_documents(data, stem, split_omnibus)
    if suffix in KINDLE:
        return kindle_documents(data, p.name, stem, split_omnibus)
    if suffix in WORD:
        return [docx_document(data, stem, p.name)]
    if suffix in HTML:
        return [Document([(*b, p.name) for b in html_blocks(decode_text(data), p.name)], {"title": stem})]
    if suffix in TEXT:
        return [Document([(*b, p.name) for b in text_blocks(decode_text(data), aggressive, numbered, strip_pages)], {"title": stem})]
    if suffix == "pdf":
        raise ValueError(f"{p.name}: PDF has no reliable paragraph structure; export the source to DOCX or EPUB")
    raise ValueError(f"{p.name}: unsupported extension {suffix!r}")


DOC_SCHEMA = (
    "rel string, doc_ord int, n_docs int, meta map<string,string>, blocks array<struct<block_ord:bigint,kind:string,text:string,level:int,origin:string>>, error string"
)


def read_documents(spark: SparkSession, root: str, rels: DataFrame, **options) -> DataFrame:
    """rel, doc_ord, n_docs, meta, blocks, error for the files of rels (column path, rel): contents are read only for them.

    A file that cannot be read gives one row with its error. Texts come from the binary scan, a file a row. The scan
    takes a list of names, as Spark's own file index holds one on the driver for every scan.
    """
    paths = [unquote(r["path"]) for r in rels.select("path").distinct().collect()]  # names of the chosen files, not contents
    if not paths:
        return spark.createDataFrame([], DOC_SCHEMA)
    scan = spark.read.format("binaryFile").load(paths).select("path", "content")
    return extracted(scan.join(rels.select("path", "rel"), "path"), **options)


def extracted(rows: DataFrame, **options) -> DataFrame:
    """rel, doc_ord, n_docs, meta, blocks, error of files (rel, content)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for rel, content in zip(b["rel"], b["content"]):
                out = []
                try:
                    docs = extract_documents(rel, bytes(content), **options)
                    for i, d in enumerate(docs):
                        blocks = [{"block_ord": j, "kind": k, "text": t, "level": lv, "origin": o} for j, (k, t, lv, o) in enumerate(d.blocks)]
                        out.append((rel, i, len(docs), {k: v for k, v in d.meta.items() if v is not None}, blocks, None))
                except Exception as e:  # one bad file must not end the run
                    out.append((rel, 0, 0, {}, [], f"{type(e).__name__}: {e}"))
                yield pd.DataFrame(out, columns=["rel", "doc_ord", "n_docs", "meta", "blocks", "error"])

    return rows.select("rel", "content").mapInPandas(run, DOC_SCHEMA)


def assemble_books(specs: DataFrame, docs: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(books, blocks, errors). One source with several documents gives a book each; else all sources make one book.

    Each document knows its unit, the spec or the part of it that becomes a book; units that would have one id are numbered.
    """
    src = specs.select("book_id", F.col("title").alias("spec_title"), "series", "order_hint", F.size("sources").alias("n_src"), F.posexplode("sources").alias("src_ord", "rel"))
    rows = src.join(docs, "rel", "left")
    failed = rows.where("error is not null or n_docs is null")
    errors = failed.groupBy("book_id").agg(F.array_join(F.array_sort(F.collect_set(F.coalesce("error", F.lit("missing source")))), "; ").alias("error"), F.array_sort(F.collect_set("rel")).alias("sources"))
    good = rows.join(errors.select("book_id"), "book_id", "left_anti")
    several = (F.col("n_src") == 1) & (F.col("n_docs") > 1)
    good = good.withColumn("part", F.when(several, F.col("doc_ord")).otherwise(-1))
    label = F.substring(X.slugify(F.coalesce(F.col("meta")["title"], F.lit(""))), 1, 60)
    suffix = F.when(label != "", label).otherwise(F.concat(F.lit("part"), F.col("doc_ord") + 1))
    ident = F.when(several, F.concat_ws("__", "book_id", suffix)).otherwise(F.col("book_id"))
    title = F.col("meta")["title"]
    units = good.groupBy(F.col("book_id").alias("spec"), "part").agg(
        F.min(ident).alias("book_id"), F.max("spec_title").alias("_spec"), F.filter(F.collect_list(title), lambda t: t != "").alias("_t"), F.count("*").alias("_n"), F.max("series").alias("series"),
        F.max(F.when(several, F.col("order_hint") * 100 + F.col("doc_ord") + 1).otherwise(F.col("order_hint"))).alias("order_hint"), F.array_sort(F.collect_list(F.struct("src_ord", "rel"))).alias("_s"),
    )
    units = cut_lineage(distinct_ids(units, ["spec", "part"]))
    books = units.select(
        "book_id", F.when((F.col("_n") == 1) & (F.size("_t") == 1), F.col("_t")[0]).otherwise(F.col("_spec")).alias("title"), "series", "order_hint",
        F.array_distinct(F.transform("_s", lambda x: x["rel"])).alias("source_files"),
    )
    # documents are far shorter than 2^32 blocks
    place = (F.col("src_ord") * 10000 + F.when(several, 0).otherwise(F.col("doc_ord"))).cast("int")
    flat = good.select(F.col("book_id").alias("spec"), "part", place.alias("doc_ord"), F.explode("blocks").alias("b")).join(units.select("spec", "part", "book_id"), ["spec", "part"])
    blocks = flat.select("book_id", "doc_ord", (F.col("doc_ord").cast("long") * (1 << 32) + F.col("b.block_ord")).alias("block_ord"), "b.kind", "b.text", "b.level", "b.origin")
    return books, blocks, errors


def without_prose(books: DataFrame, tree: DataFrame, errors: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(books with paragraphs, errors with a row for each of the others)."""
    full = tree.where("kind = 'paragraph'").select("book_id").distinct()
    empty = books.join(full, "book_id", "left_anti").select("book_id", F.lit("no paragraphs extracted").alias("error"), F.col("source_files").alias("sources"))
    return books.join(full, "book_id", "left_semi"), errors.unionByName(empty)
