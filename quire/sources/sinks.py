"""Sinks: JSON lines, columnar splits, and the packed token stream with its reader."""

from __future__ import annotations

import json
from collections.abc import Iterator
from pathlib import Path

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.functions.tokenizer import token_ids
from quire.operators.running import global_running_sum
from quire.plans.session import cut_lineage


def write_jsonl(df: DataFrame, path: str, order: list[str] | None = None) -> None:
    """Rows as JSON lines in a folder of part files, in a global order when one is given; nulls are written."""
    (df.repartitionByRange(*order).sortWithinPartitions(*order) if order else df).write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def write_jsonl_file(df: DataFrame, path: str, order: list[str]) -> int:
    """One ordered JSON-lines file on the driver's disk, streamed a partition at a time; for exports that fit there."""
    n = 0
    with open(path, "w", encoding="utf-8") as f:
        for row in df.orderBy(*order).toLocalIterator():
            f.write(json.dumps(row.asDict(recursive=True), ensure_ascii=False) + "\n")
            n += 1
    return n


def write_dataset(chunks: DataFrame, path: str) -> None:
    """id, text, n_tokens, book_id, chapter_index by split, as Parquet."""
    chunks.select("id", "text", "n_tokens", "book_id", "chapter_index", "split").write.mode("overwrite").partitionBy("split").parquet(path)


def pack_stream(chunks: DataFrame, tokenizer: str, bos: int | None, eos: int | None, max_seq_len: int) -> DataFrame:
    """id, split, ids with boundary tokens, start, end, seq_len in the order of book and chunk; raises where a sequence is too long."""
    ids = token_ids(F.col("text"), tokenizer)
    wrap = [F.array(F.lit(bos))] if bos is not None else []
    tail = [F.array(F.lit(eos))] if eos is not None else []
    cols = [c for c in ("split",) if c in chunks.columns]
    rows = chunks.select("id", "book_id", "order_in_book", *cols, F.concat(*wrap, ids, *tail).alias("ids")).withColumn("seq_len", F.size("ids").cast("long"))
    rows = cut_lineage(rows)
    longest = rows.agg(F.max("seq_len")).first()[0] or 0
    if longest > max_seq_len:
        raise AssertionError(f"a sequence of {longest} tokens exceeds {max_seq_len}")
    s = global_running_sum(rows, ["book_id", "order_in_book"], "seq_len", "end")
    return s.withColumn("start", F.col("end") - F.col("seq_len"))


def export_arrays(stream: DataFrame, folder: str) -> dict[str, int]:
    """input_ids.npy (uint32), offsets.npy and one offsets file a split (int64, n x 3), tokenized_index.jsonl, streamed to the driver's disk."""
    out = Path(folder)
    out.mkdir(parents=True, exist_ok=True)
    totals = stream.agg(F.count("*").alias("n"), F.coalesce(F.sum("seq_len"), F.lit(0)).alias("t")).first()
    ids = np.lib.format.open_memmap(out / "input_ids.npy", mode="w+", dtype=np.uint32, shape=(totals["t"],)) if totals["t"] else None
    if ids is None:
        np.save(out / "input_ids.npy", np.zeros(0, dtype=np.uint32))
    offsets, splits = np.zeros((totals["n"], 3), dtype=np.int64), []
    with open(out / "tokenized_index.jsonl", "w", encoding="utf-8") as f:
        for i, r in enumerate(stream.orderBy("start").toLocalIterator()):
            ids[r["start"] : r["end"]] = r["ids"]
            offsets[i] = (r["start"], r["end"], r["seq_len"])
            splits.append(r["split"] if "split" in stream.columns else "train")
            f.write(json.dumps({"id": r["id"], "start": r["start"], "end": r["end"], "seq_len": r["seq_len"], "split": splits[-1]}, ensure_ascii=False) + "\n")
    if ids is not None:
        ids.flush()
    np.save(out / "offsets.npy", offsets)
    for split in ("train", "val"):
        np.save(out / f"{split}_offsets.npy", offsets[[s == split for s in splits]] if splits else offsets)
    return {"n": int(totals["n"]), "tokens": int(totals["t"])}


def read_packed(folder: str, split: str = "train", max_len: int | None = None) -> Iterator[np.ndarray]:
    """Sequences of a split from the memory-mapped stream, cut to a length; all of them when the split has no file."""
    root = Path(folder)
    ids = np.load(root / "input_ids.npy", mmap_mode="r")
    own = root / f"{split}_offsets.npy"
    for start, end, _ in np.load(own if own.exists() else root / "offsets.npy"):
        yield np.asarray(ids[start:end][:max_len])


def collate(rows: DataFrame, batch: str, pad_id: int = 11, multiple: int = 8) -> DataFrame:
    """batch, input_ids, attention_mask, labels padded to the batch's longest sequence rounded up; padding is -100 in labels."""
    longest = rows.groupBy(batch).agg((F.ceil(F.max(F.size("ids")) / multiple) * multiple).cast("int").alias("_len"))
    r = rows.join(longest, batch)
    pad = lambda c, v: F.concat(c, F.array_repeat(F.lit(v), F.col("_len") - F.size(c)))
    ids = F.col("ids")
    return r.select(*[c for c in rows.columns if c != "ids"], pad(ids, pad_id).alias("input_ids"), pad(F.transform(ids, lambda _: F.lit(1)), 0).alias("attention_mask"), pad(ids, -100).alias("labels"))


def find_dataset(*roots: str) -> Path | None:
    """The first folder below the roots that holds a packed stream or a training file."""
    for root in roots:
        for name in ("input_ids.npy", "train.jsonl"):
            if found := sorted(Path(root).rglob(name)):
                return found[0].parent
    return None


def package(run: str, target: str) -> int:
    """Copy a run's artifacts and list them in manifest.json; 2 when the training file or the stream is missing."""
    import shutil

    src, dst = Path(run), Path(target)
    names = "train.jsonl val.jsonl chunks.jsonl oversize_blocks.jsonl stats.json tokenizer_info.json REPORT.md input_ids.npy offsets.npy train_offsets.npy val_offsets.npy tokenized_index.jsonl".split()
    if not (src / "train.jsonl").is_file() or not (src / "input_ids.npy").is_file():
        return 2
    dst.mkdir(parents=True, exist_ok=True)
    files = []
    for n in names:
        if (src / n).is_file():
            shutil.copy2(src / n, dst / n)
            files.append({"name": n, "bytes": (dst / n).stat().st_size})
    (dst / "manifest.json").write_text(json.dumps({"files": files}, indent=2), encoding="utf-8")
    return 0
