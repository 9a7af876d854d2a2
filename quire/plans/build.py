"""A whole build: files to blocks to hierarchy to chunks, checked, split, counted and written."""

from __future__ import annotations

import json
import time
from dataclasses import asdict, dataclass, field
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.functions.tokenizer import load_tokenizer
from quire.functions.tokens import MAX_SEQ_LEN, RESERVED_TOKENS, word_count
from quire.operators import checks, packing, splits, stats, structure
from quire.plans.report import render_report
from quire.plans.session import cut_lineage, importable
from quire.sources import files as sources
from quire.sources import sinks


def option(default: object, section: str, text: str, flag: str = "", recipe: str | None = "", choices: tuple[str, ...] = (), kind: type | None = None):
    """A field of the configuration that says how it is set.

    section: heading of its option and first part of its recipe key. flag: its option where that is not its name; a
    yes-or-no field has the option that turns its default over. recipe: its key, None for fields that recipes do not set.
    """
    return field(default=default, metadata={"section": section, "text": text, "flag": flag, "recipe": recipe, "choices": choices, "kind": kind})


@dataclass(frozen=True)
class BuildConfig:
    """What a run does. Names of options and recipe keys are fixed values."""

    raw_root: str = option("data/raw", "", "folder of source books", recipe=None)
    out_root: str = option("data/out", "", "folder of outputs", recipe=None)
    run_name: str = option("run", "", "subfolder of this run")
    manifest: str | None = option(None, "", "YAML file of the books and their sources", recipe=None)
    max_seq_len: int = option(MAX_SEQ_LEN, "budget", "window of the target model")
    reserved_boundary_tokens: int = option(RESERVED_TOKENS, "budget", "tokens kept free for boundaries")
    block_separator: str = option("\n\n", "budget", "text between blocks")
    tokenizer: str | None = option(None, "budget", "vocabulary file; counts are approximate without one", recipe=None)
    include_chapter_headings: bool = option(True, "chunking", "leave chapter headings out", "--no-chapter-headings")
    include_scene_headings: bool = option(True, "chunking", "leave scene headings out", "--no-scene-headings")
    repeat_chapter_title: bool = option(False, "chunking", "accepted for recipes; the packer never repeats titles")
    min_chunk_tokens: int = option(0, "chunking", "merge smaller chunks into the one before")
    merge_across_chapters: bool = option(False, "chunking", "let that merge cross chapters")
    oversize_scene_policy: str = option("split", "chunking", "what becomes of a scene larger than the budget", choices=("split", "exclude"))
    exclude_patterns: tuple[str, ...] = option((), "sources", "shell pattern of books to leave out", "--exclude", kind=list)
    split_omnibuses: bool = option(True, "sources", "keep collections whole", "--no-split-omnibuses", recipe=None)
    aggressive_breaks: bool = option(False, "sources", "a lone dash line parts scenes")
    numbered_breaks: bool = option(False, "sources", "a bare number parts scenes")
    strip_page_numbers: bool = option(False, "sources", "drop lines that are page numbers")
    drop_repeated_headings: bool = option(True, "sources", "keep headings that repeat the title", "--keep-repeated-headings")
    val_fraction: float = option(0.1, "splits", "share of validation")
    split_by: str = option("book", "splits", "unit that stays in one split", recipe="strategy", choices=("book", "chapter", "none"))
    val_books: tuple[str, ...] = option((), "splits", "books of validation", kind=tuple)
    oversize_warn_fraction: float = option(0.005, "review_gates", "share of excluded tokens that asks for a review")
    oversize_stop_fraction: float = option(0.02, "review_gates", "share of excluded tokens that stops a run")
    write_chunks: bool = option(True, "outputs", "skip the combined file", "--no-chunks-jsonl", recipe="chunks_jsonl")
    emit_tokenized: bool = option(False, "outputs", "write the packed token stream")
    emit_dataset: bool = option(False, "outputs", "write Parquet by split", "--emit-hf-dataset", recipe="emit_hf_dataset")
    part_files: bool = option(False, "outputs", "write JSON lines as folders of part files, in parallel", recipe=None)

    def __post_init__(self) -> None:
        if self.split_by not in ("book", "chapter", "none"):
            raise ValueError("split_by must be 'book', 'chapter' or 'none'")
        if not 0.0 <= self.val_fraction < 1.0:
            raise ValueError("val_fraction must be in [0, 1)")
        self.packing()

    def packing(self) -> packing.PackConfig:
        return packing.PackConfig(
            self.max_seq_len, self.reserved_boundary_tokens, self.block_separator, self.include_chapter_headings, self.include_scene_headings, self.oversize_scene_policy, self.min_chunk_tokens,
            self.merge_across_chapters, self.tokenizer,
        )


@dataclass
class BuildResult:
    """Relations of a run and its statistics."""

    books: DataFrame
    chunks: DataFrame
    oversize: DataFrame
    excluded: DataFrame
    errors: DataFrame
    stats: dict = field(default_factory=dict)


def run_build(spark: SparkSession, cfg: BuildConfig) -> BuildResult:
    """Plan, read, pack, verify, split and count. Excluded books are never read; a bad file costs its book only."""
    importable(spark)
    began = time.time()
    listing = sources.list_files(spark, cfg.raw_root).cache()
    specs = sources.load_manifest(spark, cfg.manifest, listing) if cfg.manifest else sources.discover_books(listing)
    specs = sources.mark_excluded(specs, list(cfg.exclude_patterns))
    excluded = specs.where("matched_pattern is not null").select("book_id", "title", "series", "matched_pattern", "sources")
    kept = specs.where("matched_pattern is null").drop("matched_pattern")
    wanted = listing.join(kept.select(F.explode("sources").alias("rel")).distinct(), "rel")
    docs = cut_lineage(sources.read_documents(spark, cfg.raw_root, wanted, aggressive=cfg.aggressive_breaks, numbered=cfg.numbered_breaks, strip_pages=cfg.strip_page_numbers, split_omnibus=cfg.split_omnibuses))
    books, blocks, errors = sources.assemble_books(kept, docs)
    if cfg.drop_repeated_headings:
        blocks = structure.drop_running_heads(blocks, books.select("book_id", "title"))
    structure.require_unique(blocks)
    tree = cut_lineage(structure.hierarchy(blocks))
    books, errors = sources.without_prose(books, tree, errors)
    chunks, oversize = packing.pack(tree, books, cfg.packing())
    checks.verify(chunks, cfg.packing().budget)
    val = None
    if cfg.split_by == "book":
        val = splits.choose_val_books(books, cfg.val_fraction, list(cfg.val_books) or None)
    chunks = splits.assign_splits(chunks, cfg.split_by, cfg.val_fraction, val)
    result = BuildResult(books, chunks, oversize, excluded, errors)
    result.stats = collect_stats(cfg, result, tree, val)
    result.stats["build_seconds"] = round(time.time() - began, 1)
    listing.unpersist()
    return result


def _row(df: DataFrame) -> dict:
    return df.first().asDict(recursive=True)


def collect_stats(cfg: BuildConfig, r: BuildResult, tree: DataFrame, val: DataFrame | None) -> dict:
    """The statistics document, from one-row aggregates and one row a book."""
    budget = cfg.packing().budget
    para = F.col("kind") == "paragraph"
    per_tree = tree.groupBy("book_id").agg(
        F.countDistinct("chapter_index").alias("chapters"), F.countDistinct(F.when(F.col("scene_index").isNotNull(), F.struct("chapter_index", "scene_index"))).alias("scenes"), F.count_if(para).alias("paragraphs"),
        F.sum(F.when(para, word_count(F.col("text"))).otherwise(0)).alias("words"),
    )
    per_chunks = r.chunks.groupBy("book_id").agg(F.count("*").alias("chunks"), F.sum("n_tokens").alias("content_tokens"))
    held = (val if val is not None else r.books.limit(0)).select("book_id", F.lit(True).alias("in_val_split"))
    per = r.books.select("book_id", "title", "series", "source_files").join(per_tree, "book_id", "left").join(per_chunks, "book_id", "left").join(held, "book_id", "left")
    per = cut_lineage(per.na.fill(0).na.fill(False, ["in_val_split"]))
    totals, lengths = _row(stats.chunk_totals(r.chunks, budget, cfg.reserved_boundary_tokens)), _row(stats.length_summary(r.chunks))
    by_split = {x["split"]: x for x in stats.split_totals(r.chunks).collect()}
    by_kind = {x["kind"]: {"count": x["n"], "tokens": x["n_tokens"], "actions": x["actions"]} for x in stats.oversize_by_kind(r.oversize).collect()}
    out = _row(stats.excluded_fraction(r.chunks, r.oversize))
    corpus = _row(per.agg(F.count("*").alias("books_included"), *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("chapters", "scenes", "paragraphs", "words")]))
    n_excluded = r.excluded.count()
    one = lambda s, k: by_split[s][k] if s in by_split else 0
    return {
        "run_name": cfg.run_name, "generated_at_utc": time.strftime("%Y-%m-%dT%H:%M:%SZ", time.gmtime()),
        "budget": {"max_seq_len": cfg.max_seq_len, "reserved_boundary_tokens": cfg.reserved_boundary_tokens, "content_budget": budget, "block_separator": repr(cfg.block_separator)},
        "tokenizer": (load_tokenizer(cfg.tokenizer) if cfg.tokenizer else packing.load_proxy()).info.as_dict(),
        "corpus": corpus | {"books_excluded": n_excluded, "books_total": corpus["books_included"] + n_excluded},
        "dataset": {
            "chunks": totals["n_chunks"], "content_tokens": totals["content_tokens"], "boundary_tokens": totals["boundary_tokens"], "training_tokens_including_boundaries": totals["total_tokens"],
            "chunk_tokens": lengths if lengths["n"] else {"n": 0}, "train_chunks": one("train", "n_chunks"), "val_chunks": one("val", "n_chunks"), "train_tokens": one("train", "n_tokens"), "val_tokens": one("val", "n_tokens"),
            "budget_utilisation": totals["utilisation"],
        },
        "boundaries": {
            "chunks_opening_a_chapter": totals["starts_chapter"], "chunks_opening_a_scene": totals["starts_scene"], "chunks_ending_on_a_scene": totals["ends_scene"], "chunks_resuming_a_scene": totals["continues_scene"],
            "pct_ending_on_a_scene": totals["ends_scene_pct"], "pct_opening_at_a_boundary": totals["opens_at_boundary_pct"],
        },
        "oversize": {
            "records": sum(k["count"] for k in by_kind.values()), "by_kind": by_kind, "excluded_tokens": out["excluded_tokens"], "excluded_fraction": out["fraction"], "warn_fraction": cfg.oversize_warn_fraction,
            "stop_fraction": cfg.oversize_stop_fraction, "review_required": out["fraction"] >= cfg.oversize_warn_fraction, "stop": out["fraction"] >= cfg.oversize_stop_fraction,
        },
        "splits": {"strategy": cfg.split_by, "val_fraction": cfg.val_fraction, "val_books": sorted(x["book_id"] for x in per.where("in_val_split").select("book_id").collect())},
        "exclusions": {"patterns": list(cfg.exclude_patterns), "matched": [x.asDict() for x in r.excluded.orderBy("book_id").collect()]},
        "provenance": {"raw_root": cfg.raw_root, "manifest": cfg.manifest, "books": [x.asDict() for x in per.drop("words").orderBy("book_id").collect()]},
        "errors": [x.asDict() for x in r.errors.orderBy("book_id").collect()],
    }


def write_outputs(cfg: BuildConfig, r: BuildResult) -> Path:
    """Artifacts of a run under out_root/run_name; returns the folder.

    JSON lines are single files that stream through the driver, or with part_files folders that executors write in
    parallel, in the same order; choose these for a corpus that does not fit the driver's disk.
    """
    out = Path(cfg.out_root) / cfg.run_name
    out.mkdir(parents=True, exist_ok=True)
    order = ["book_id", "order_in_book"]
    rows = r.chunks
    write = sinks.write_jsonl if cfg.part_files else sinks.write_jsonl_file
    if cfg.write_chunks:
        write(rows.drop("split"), str(out / "chunks.jsonl"), order)
    for split in ("train", "val"):
        write(rows.where(F.col("split") == split).drop("split"), str(out / f"{split}.jsonl"), order)
    write(r.oversize, str(out / "oversize_blocks.jsonl"), ["book_id", "chapter", "scene", "paragraph", "kind"])
    (out / "stats.json").write_text(json.dumps(r.stats, indent=2, ensure_ascii=False, default=str), encoding="utf-8")
    (out / "tokenizer_info.json").write_text(json.dumps(r.stats["tokenizer"], indent=2, ensure_ascii=False), encoding="utf-8")
    (out / "REPORT.md").write_text(render_report(r.stats), encoding="utf-8")
    if cfg.emit_tokenized:
        if not cfg.tokenizer:
            raise RuntimeError("a token stream needs a vocabulary")
        info = r.stats["tokenizer"]
        sinks.export_arrays(sinks.pack_stream(rows, cfg.tokenizer, info["bos_id"], info["eos_id"], cfg.max_seq_len), str(out))
    if cfg.emit_dataset:
        sinks.write_dataset(rows, str(out / "dataset"))
    (out / "config.json").write_text(json.dumps(asdict(cfg), indent=2), encoding="utf-8")
    return out
