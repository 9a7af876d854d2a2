"""Running aggregates that hold no whole group in one task."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: Order numbers a segment.
SEGMENT = 4096


def running(df: DataFrame, keys: list[str], order: list[str], segment: str, **parts: tuple[str, Column]) -> DataFrame:
    """df with name=(how, value): the running 'sum' or 'max' of value over the rows before and at each row of its key.

    Rows are windowed within (keys, segment) only; the segments' totals, one row each, are accumulated apart and
    joined back on the same columns, so a key of any size is spread over as many tasks as it has segments. The
    segment must not decrease along the order.
    """
    inner = W.partitionBy(*keys, segment).orderBy(*order).rowsBetween(W.unboundedPreceding, 0)
    fold = {"sum": F.sum, "max": F.max}
    local = reduce(lambda d, x: d.withColumn(x[0], fold[x[1][0]](x[1][1]).over(inner)), parts.items(), df)
    totals = df.groupBy(*keys, segment).agg(*[fold[how](value).alias(f"_{name}") for name, (how, value) in parts.items()])
    outer = W.partitionBy(*keys).orderBy(segment).rowsBetween(W.unboundedPreceding, -1)
    before = totals.select(*keys, segment, *[fold[how](f"_{name}").over(outer).alias(f"_{name}") for name, (how, _) in parts.items()])
    # keys may be null: compare them null-safe
    left, right = local.alias("l"), before.alias("r")
    on = reduce(lambda a, b: a & b, [F.col(f"l.{k}").eqNullSafe(F.col(f"r.{k}")) for k in [*keys, segment]])
    joined = left.join(right, on, "left")
    kept = [F.col(f"l.{c}") for c in df.columns]
    combine = {"sum": lambda a, b: F.coalesce(a, F.lit(0)) + F.coalesce(b, F.lit(0)), "max": lambda a, b: F.greatest(a, b)}
    return joined.select(*kept, *[combine[how](F.col(f"l.{name}"), F.col(f"r._{name}")).alias(name) for name, (how, _) in parts.items()])


def global_running_sum(df: DataFrame, order: list[str], value: str, name: str) -> DataFrame:
    """df with the sum of value over all rows before and at each row in a global order.

    The rows are range-partitioned by the order; one sum a partition goes to the driver.
    """
    from quire.plans.session import cut_lineage

    n = max(1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    parted = cut_lineage(df.repartitionByRange(n, *order).withColumn("_part", F.spark_partition_id()))
    sums = sorted((r["_part"], r["s"] or 0) for r in parted.groupBy("_part").agg(F.sum(value).alias("s")).collect())
    offsets, total = [], 0
    for p, s in sums:
        offsets.append((p, total))
        total += s
    table = df.sparkSession.createDataFrame(offsets or [(0, 0)], "_part int, _before long")
    w = W.partitionBy("_part").orderBy(*order).rowsBetween(W.unboundedPreceding, 0)
    return parted.join(F.broadcast(table), "_part").withColumn(name, F.col("_before") + F.sum(F.coalesce(F.col(value), F.lit(0))).over(w)).drop("_part", "_before")
