"""Problem 7: ids of every document by a public byte-pair vocabulary.

The words of all documents are counted; the LEXICON most frequent ones are compiled with their ids into a
minimal acyclic transducer, which lies in the shared folder and is memory-mapped by the workers (broadcast
where that folder is no file system). Words it lacks go through the exact merges. A worker remembers what it
has resolved, in a memory of bounded size, so most text costs one dictionary look-up a word.

Defined results: null and empty texts get the empty list, white space and control characters are encoded like
anything else; every row of the input gives one row, repeated or not.
"""

from __future__ import annotations

import atexit
import base64
import hashlib
import os
import re
import uuid
from collections import Counter
from collections.abc import Callable, Iterator
from itertools import chain
from pathlib import Path
from typing import ClassVar
from urllib.parse import urlparse

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quire.llm.lexicon import Lexicon, compile_lexicon, merge_word
from quire.plans.session import cut_lineage, most_frequent, read_table, shared_dir

#: Where the public vocabularies are; words in the transducer; units a worker remembers.
TOKENIZERS = os.environ.get("QUIRE_TOKENIZERS", "/opt/tokenizers")
LEXICON, MEMORY = 60_000, 400_000
#: Fixed value: the pattern that splits text before the merges of the rank files.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: A blank before more white space: only there do words depend on what stands around a blank.
_RUN = re.compile(r" (?=\s)")


def read_ranks(folder: str = TOKENIZERS, name: str = "byte_bpe_50k") -> dict[bytes, int]:
    """Byte strings of the vocabulary and their ids."""
    lines = (Path(folder) / f"{name}.tiktoken").read_bytes().splitlines()
    return {base64.b64decode(a): int(b) for a, b in (x.split() for x in lines if x)}


class Encoder:
    """Encodes texts with a lexicon, the merges behind it, and a memory of blank-separated units."""

    def __init__(self, lexicon: Lexicon, ranks: dict[bytes, int]):
        import regex

        self.words = regex.compile(PATTERN).findall
        self.lexicon, self.ranks = lexicon, ranks
        self.memory: dict[str, list[int]] = {}

    _runs: ClassVar[dict[str, Encoder]] = {}

    @classmethod
    def of_run(cls, key: str, lexicon: Callable[[], Lexicon], ranks: dict[bytes, int]) -> Encoder:
        """The encoder of the run at hand: a worker keeps its memory from task to task."""
        if key not in cls._runs:
            cls._runs.clear()
            cls._runs[key] = cls(lexicon(), ranks)
        return cls._runs[key]

    def unit(self, text: str) -> list[int]:
        ids: list[int] = []
        for w in self.words(text):
            word = w.encode("utf-8", "replace")
            ids += self.lexicon.get(word) or merge_word(word, self.ranks)
        return ids

    def encode(self, text: str | None) -> list[int]:
        if not text:
            return []
        if _RUN.search(text):
            return self.unit(text)
        units = text.split(" ")
        memory = self.memory
        if len(memory) > MEMORY:
            memory.clear()
        for u in set(units[1:]):
            if u not in memory:
                memory[u] = self.unit(" " + u)
        return list(chain(self.unit(units[0]) if units[0] else (), chain.from_iterable(map(memory.__getitem__, units[1:]))))


def count_words(texts: DataFrame) -> DataFrame:
    """word, n over all rows of the column text; words are counted in the partition before they are shuffled."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import regex

        words = regex.compile(PATTERN).findall
        units, got = Counter(), Counter()
        for b in batches:
            for t in b.column(0).to_pylist():
                if not t:
                    continue
                if _RUN.search(t):
                    got.update(words(t))
                else:
                    head, *rest = t.split(" ")
                    got.update(words(head))
                    units.update(rest)
            if len(units) > MEMORY:
                yield from _flush(units, got, words)
        yield from _flush(units, got, words)

    return texts.where("text is not null").select("text").mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def _flush(units: Counter, got: Counter, words) -> Iterator[pa.RecordBatch]:
    for u, n in units.items():
        for w in words(" " + u):
            got[w] += n
    keys = list(got)
    for i in range(0, len(keys), 50_000):
        part = keys[i : i + 50_000]
        yield pa.RecordBatch.from_arrays([pa.array([w.encode("utf-8", "replace").decode() for w in part], pa.string()), pa.array([got[w] for w in part], pa.int64())], names=["word", "n"])
    units.clear()
    got.clear()


def build_lexicon(texts: DataFrame, ranks: dict[bytes, int], size: int = LEXICON) -> bytes:
    """The compiled most frequent words, at most `size`, all of a count or none; no more rows come to the driver."""
    top = most_frequent(cut_lineage(count_words(texts)), size).select("word").toPandas()["word"]
    return compile_lexicon((w.encode(), tuple(merge_word(w.encode(), ranks))) for w in top)


def encode_documents(docs: DataFrame, text: str = "text", folder: str = TOKENIZERS, name: str = "byte_bpe_50k", size: int = LEXICON) -> DataFrame:
    """The columns of docs but the text, and ids."""
    spark = docs.sparkSession
    ranks = read_ranks(folder, name)
    block = build_lexicon(docs.select(F.col(text).alias("text")), ranks, size)
    to = urlparse(shared_dir(spark))
    key, held = uuid.uuid4().hex, None
    path = os.path.join(to.path, f"lexicon-{key}.bin")
    if to.scheme == "file":  # a disk that workers see; the driver removes the file when it ends, as tasks may be run again until then
        os.makedirs(to.path, exist_ok=True)
        Path(path).write_bytes(block)
        atexit.register(Path(path).unlink, missing_ok=True)
    else:
        held = spark.sparkContext.broadcast(block)  # a few MB, by LEXICON
    vocabulary = spark.sparkContext.broadcast(ranks)  # the vocabulary's own size
    others = [c for c in docs.columns if c != text]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = Encoder.of_run(key, lambda: Lexicon(held.value if held else np.memmap(path, dtype=np.int32, mode="r")), vocabulary.value).encode
        for b in batches:
            lists = [encode(t) for t in b.column(len(others)).to_pylist()]
            at = np.zeros(len(lists) + 1, dtype=np.int32)
            np.cumsum([len(x) for x in lists], out=at[1:])
            flat = np.fromiter(chain.from_iterable(lists), dtype=np.int32, count=int(at[-1]))
            kept = [c.combine_chunks() if isinstance(c, pa.ChunkedArray) else c for c in (b.column(i) for i in range(len(others)))]
            yield pa.RecordBatch.from_arrays([*kept, pa.ListArray.from_arrays(pa.array(at), pa.array(flat))], names=[*others, "ids"])

    schema = docs.select(*others).schema.add("ids", T.ArrayType(T.IntegerType()))
    return docs.select(*others, text).mapInArrow(run, schema)


def p7_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, ids of every document."""
    return encode_documents(read_table(spark, sf_dir, "documents").select("doc_id", "text"))


def p7_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id and the digest of what its ids decode to, which is that of its text."""
    ranks = read_ranks()
    table: list[bytes] = [b""] * (max(ranks.values()) + 1)
    for word, i in ranks.items():
        table[i] = word
    held = spark.sparkContext.broadcast(table)  # the vocabulary's own size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        word = held.value.__getitem__
        for b in batches:
            digests = [hashlib.md5(b"".join(map(word, ids))).hexdigest() for ids in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(digests, pa.string())], names=["doc_id", "digest"])

    return p7_ids(spark, sf_dir).mapInArrow(run, "doc_id long, digest string")
