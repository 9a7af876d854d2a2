"""Session helpers: table access, shared folder for checkpoints, bounded broadcasts."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Largest relation that may be broadcast, in bytes as Spark holds it: a row's numbers and 40 bytes for each of its strings and arrays.
BROADCAST_LIMIT = 256 << 20


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the test tables; columns are pruned and filters pushed by the reader."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share, as the cluster names it in spark.checkpoint.dir.

    Only a local master without that setting gets a temporary folder of its own.
    """
    sc = spark.sparkContext
    held = sc._jsc.sc().getCheckpointDir
    named = sc.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if named and not held().isDefined():
        sc.setCheckpointDir(named)
    if held().isDefined():
        return held().get()  # with the file system that Spark resolved the setting to
    if not sc.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="quire-")
    atexit.register(shutil.rmtree, folder, True)
    sc._jsc.sc().conf().set("spark.cleaner.referenceTracking.cleanCheckpoints", "true")  # files go with their relation
    sc.setCheckpointDir(f"file://{folder}")
    return held().get()


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise df once in the shared folder; later reads survive the loss of executors."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def row_bytes(df: DataFrame) -> int:
    """What a row takes in a broadcast relation: 16 bytes and 8 a column, 40 more for each string, binary or nested value."""
    fixed = {"boolean", "tinyint", "smallint", "int", "bigint", "float", "double", "date", "timestamp", "timestamp_ntz"}
    return 16 + sum(8 + 40 * (f.dataType.simpleString() not in fixed) for f in df.schema)


def small_broadcast(df: DataFrame, rows: int, limit_rows: int = 200_000) -> DataFrame:
    """Mark df for broadcast only while its counted rows are within limit_rows and its bytes within BROADCAST_LIMIT."""
    return F.broadcast(df) if rows <= limit_rows and rows * row_bytes(df) <= BROADCAST_LIMIT else df


def most_frequent(counts: DataFrame, size: int, count: str = "n") -> DataFrame:
    """The rows of the largest counts, at most `size`: as many whole steps of counts as fit.

    A top-n would send n rows of every partition to the driver. Steps of the logarithm, of which there are at most
    some hundreds, tell the count from which the rows fit, and only those are kept. Read counts from a cut lineage.
    """
    step = F.floor(F.log2(F.col(count).cast("double")) * 16)
    total, floor = 0, None
    for r in sorted(counts.where(F.col(count) > 0).groupBy(step.alias("step")).agg(F.count("*").alias("k")).collect(), key=lambda r: -r["step"]):
        total += r["k"]
        if total > size:
            break
        floor = r["step"]
    return counts.where(F.col(count) > 0).where(step >= floor) if floor is not None else counts.limit(0)


def importable(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver has it.

    Enough where workers see the driver's folders (local mode, a shared mount); elsewhere install the package
    or pass it with --py-files, which then comes first.
    """
    root = str(Path(__file__).resolve().parents[2])
    env = spark.sparkContext.environment
    if root not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(x for x in (env.get("PYTHONPATH", ""), root) if x)
