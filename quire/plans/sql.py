"""The SQL face of the engine: functions, a table function, and the relations of a build as views."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType

from quire.plans.build import BuildResult
from quire.plans.session import importable


class ExtractBlocks:
    """Blocks of one file: SELECT b.* FROM files, LATERAL extract_blocks(path, content) b. A bad file gives one row with its error."""

    def eval(self, path: str, content: bytes) -> Iterator[tuple]:
        from quire.sources.files import extract_documents

        try:
            docs = extract_documents(path, bytes(content or b""))
        except Exception as e:  # an unreadable file is a row, not a failed query
            yield 0, 0, None, None, None, None, f"{type(e).__name__}: {e}"
            return
        for i, d in enumerate(docs):
            for j, (kind, text, level, origin) in enumerate(d.blocks):
                yield i, j, kind, text, level, origin, None


def register(spark: SparkSession, tokenizer: str | None = None) -> None:
    """token_count(text) by a vocabulary (or the approximate price), extract_blocks(path, content)."""
    importable(spark)

    @F.pandas_udf(IntegerType())
    def token_count(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        from quire.functions.tokenizer import load_tokenizer
        from quire.operators.packing import load_proxy

        counter = load_tokenizer(tokenizer) if tokenizer else load_proxy()
        for b in batches:
            yield b.map(lambda t: 0 if t is None else counter.count(t)).astype("int32")

    spark.udf.register("token_count", token_count)
    spark.udtf.register("extract_blocks", F.udtf(ExtractBlocks, returnType="doc_ord int, block_ord int, kind string, text string, level int, origin string, error string"))


def views(result: BuildResult, prefix: str = "") -> list[str]:
    """Temporary views books, chunks, oversize, excluded and errors of a build."""
    names = []
    for name in ("books", "chunks", "oversize", "excluded", "errors"):
        getattr(result, name).createOrReplaceTempView(prefix + name)
        names.append(prefix + name)
    return names
