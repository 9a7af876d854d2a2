"""Problem 3: fill fixed-capacity containers with whole items by a configuration linear program.

The items enter only as a histogram over their lengths, at most one row a length up to the capacity, so its size is
bounded whatever the data. The covering program "fewest containers, each with a feasible pattern of lengths, so that
every item is placed" is solved by multiplicative weights: a length weighs less the more of it the patterns so far
cover, and a knapsack dynamic program prices the next pattern. The fractional pattern counts are rounded down, once
all patterns and once only those that leave little room, and what is left is placed best fit decreasing, runs of equal
containers at a time. Plain best fit decreasing is a third candidate; the fewest containers win, so the result is
never worse than that heuristic. The weights also give a lower bound on the number of containers.

Items are ranked within their length, partition by partition, and each rank looks up its container; no group of items
is ever gathered, and nothing that grows with the number of partitions leaves the executors.

Defined results: an item larger than the capacity is split into full pieces, each a container of its own, and
a remainder that is packed; an empty item takes one unit; k items in a container also pay k - 1 separators;
null or wrong counts are recounted; repeated rows are one item. Unknown levels of budgets are left out.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quire.llm.items import all_items, budget_of
from quire.plans.session import cut_lineage

#: Units the capacity is divided into at most for pricing, step of the weights, rounds of the program.
UNITS, STEP, ROUNDS = 768, 0.25, 250
#: Shares of the capacity that a rounded pattern may leave empty, one attempt each.
SLACK = (1.0, 0.01, 0.002)

Pattern = dict[int, int]  # place of a length in the histogram -> items of it


class Knapsack:
    """Most valuable patterns over sizes in units, each item at most `most` times; sizes are split into powers of two."""

    def __init__(self, sizes: np.ndarray, most: np.ndarray, units: int):
        self.units = units
        self.parts: list[tuple[int, int]] = []  # (item, copies)
        for i in np.argsort(sizes, kind="stable"):
            left, k = int(min(most[i], units // max(int(sizes[i]), 1))), 1
            while left > 0:
                self.parts.append((int(i), min(k, left)))
                left -= k
                k *= 2
        self.sizes = sizes

    def best(self, values: np.ndarray) -> tuple[float, Pattern]:
        """(value, pattern) of the best filling."""
        worth = np.zeros(self.units + 1)
        took = np.zeros((len(self.parts), self.units + 1), dtype=bool)
        for row, (i, k) in enumerate(self.parts):
            size = k * int(self.sizes[i])
            if size > self.units:
                continue
            other = worth[: self.units + 1 - size] + k * values[i]
            better = other > worth[size:]
            took[row, size:] = better
            worth[size:][better] = other[better]
        pattern: Pattern = {}
        room = self.units
        for row in range(len(self.parts) - 1, -1, -1):
            if took[row, room]:
                i, k = self.parts[row]
                pattern[i] = pattern.get(i, 0) + k
                room -= k * int(self.sizes[i])
        return float(worth[-1]), pattern


def fractional(lengths: np.ndarray, counts: np.ndarray, capacity: int, rounds: int = ROUNDS) -> tuple[dict[tuple, float], float]:
    """(amount of each pattern, lower bound on the containers) by multiplicative weights."""
    unit = max(1, -(-capacity // UNITS))
    units = capacity // unit
    sizes = np.minimum(-(-lengths // unit), units)
    sack = Knapsack(sizes, counts, units)
    n = counts.astype(float)
    covered, used = np.zeros(len(n)), {}
    weight = lengths / capacity
    for _ in range(rounds):
        _, pattern = sack.best(weight)
        room = capacity - sum(int(lengths[i]) * k for i, k in pattern.items())
        i = len(lengths)
        while (i := min(i, int(np.searchsorted(lengths, room, side="right"))) - 1) >= 0:  # what rounding to units left free
            extra = min(room // int(lengths[i]), int(counts[i]) - pattern.get(i, 0))
            if extra > 0:
                pattern[i] = pattern.get(i, 0) + extra
                room -= extra * int(lengths[i])
        amount = STEP * min(n[i] / k for i, k in pattern.items())
        key = tuple(sorted(pattern.items()))
        used[key] = used.get(key, 0.0) + amount
        for i, k in pattern.items():
            covered[i] += amount * k / n[i]
        if covered.min() >= 1:
            break
        # a length in demand is worth its room, and more the less of it is covered
        weight = lengths / capacity * np.exp(-(covered - covered.mean()) * 0.5 / STEP / max(1.0, covered.max()))
    scale = 1 / max(float(np.average(covered, weights=n * lengths)), 1e-9)
    # any weights bound the containers from below, when no pattern weighs more than one; sizes rounded down allow every pattern
    under = Knapsack(lengths // unit, counts, units)
    bound = float(n @ lengths) / capacity
    for w in (lengths / capacity, (lengths > capacity / 2) * 1.0 + (2 * lengths == capacity) * 0.5):
        value, _ = under.best(w)
        bound = max(bound, float(n @ w) / value if value else 0.0)
    return {k: x * scale for k, x in used.items()}, bound


def best_fit(lengths: np.ndarray, counts: np.ndarray, capacity: int) -> list[tuple[int, Pattern]]:
    """(copies, pattern) of best fit decreasing: each item goes where it leaves the least room. Equal containers are one group."""
    copies: list[int] = []
    rooms = np.empty(0, np.int64)
    patterns: list[Pattern] = []
    for i in range(len(lengths) - 1, -1, -1):
        size, left = int(lengths[i]), int(counts[i])
        if not left:
            continue
        fits = np.flatnonzero(rooms >= size)
        new_rooms = []
        # the tightest container takes items until it is full
        for g in fits[np.argsort(rooms[fits], kind="stable")]:
            if not left:
                break
            each = int(rooms[g]) // size
            full = min(copies[g], left // each)
            part = left - full * each if full < copies[g] else 0
            part = min(part, each - 1) if full < copies[g] else 0
            rest = copies[g] - full - (part > 0)
            made = [(full, each)] * (full > 0) + [(1, part)] * (part > 0)
            left -= full * each + part
            before, room = patterns[g], int(rooms[g])
            for j, (k, q) in enumerate(made):
                if j == 0:
                    copies[g], patterns[g], rooms[g] = k, {**before, i: q}, room - q * size
                else:
                    copies.append(k)
                    patterns.append({**before, i: q})
                    new_rooms.append(room - q * size)
            if made and rest:
                copies.append(rest)
                patterns.append(before)
                new_rooms.append(room)
        if left:
            each = capacity // size
            for k, q in ((left // each, each), (1, left % each)):
                if k and q:
                    copies.append(k)
                    patterns.append({i: q})
                    new_rooms.append(capacity - q * size)
        rooms = np.concatenate([rooms, np.array(new_rooms, np.int64)])
    return list(zip(copies, patterns))


def solve(lengths: np.ndarray, counts: np.ndarray, capacity: int) -> tuple[list[tuple[int, Pattern]], int]:
    """(copies, pattern) for every pattern used, placing each item exactly once, and a lower bound on their number."""
    counts = counts.astype(np.int64)
    amounts, bound = fractional(lengths, counts, capacity)
    least = max(int(np.ceil(bound - 1e-6)), 1)
    plain = best_fit(lengths, counts, capacity)
    best = plain
    ordered = sorted(amounts.items(), key=lambda t: (-sum(int(lengths[i]) * k for i, k in t[0]), t[0]))
    for slack in SLACK:
        left, rounded = counts.copy(), []
        for pattern, amount in ordered:
            if capacity - sum(int(lengths[i]) * k for i, k in pattern) > slack * capacity:
                break
            copies = min(int(amount), *(int(left[i]) // k for i, k in pattern))
            if copies:
                for i, k in pattern:
                    left[i] -= copies * k
                rounded.append((copies, dict(pattern)))
        made = rounded + best_fit(lengths, left, capacity)
        if sum(k for k, _ in made) < sum(k for k, _ in best):
            best = made
    return best, least


@dataclass
class Plan:
    """Containers of a level: its lengths, and of each the ranks at which a pattern begins, its items a container and its number."""

    lengths: np.ndarray
    first: list[np.ndarray]
    each: list[np.ndarray]
    pattern: list[np.ndarray]


def plan_of(lengths: np.ndarray, patterns: list[tuple[int, Pattern]]) -> Plan:
    rows: list[list[tuple[int, int, int]]] = [[] for _ in lengths]
    at = np.zeros(len(lengths), np.int64)
    for number, (copies, pattern) in enumerate(patterns):
        for i, k in pattern.items():
            rows[i].append((int(at[i]), k, number))
            at[i] += copies * k
    columns = [tuple(np.array(c, np.int64) for c in zip(*r)) for r in rows]
    return Plan(lengths, *[[c[j] for c in columns] for j in range(3)])


def sized_items(items: DataFrame, budgets: dict[str, tuple[int, int, int]]) -> DataFrame:
    """items with full, the pieces of a whole capacity, rest, what remains, and size, the room it takes with its separator; cut off its lineage."""
    limits = items.sparkSession.createDataFrame([(k, c, s) for k, (c, _, s) in budgets.items()], "item_level string, capacity int, sep int")
    return cut_lineage(
        items.join(F.broadcast(limits), "item_level")  # a fixed table of a few rows
        .withColumn("full", F.when(F.col("n") > F.col("capacity"), F.floor((F.col("n") - 1) / F.col("capacity"))).otherwise(0).cast("int"))
        .withColumn("rest", (F.col("n") - F.col("full") * F.col("capacity")).cast("int"))
        .withColumn("size", F.greatest(F.col("rest") + F.col("sep"), F.lit(1)))
        .withColumn("part", F.spark_partition_id())
    )


def solutions(sized: DataFrame, budgets: dict[str, tuple[int, int, int]]) -> dict[str, tuple[np.ndarray, list[tuple[int, Pattern]], int]]:
    """Level -> (lengths, patterns, lower bound on the containers)."""
    out = {}
    # one row for each level and length up to its capacity, however many items there are
    histogram = sized.groupBy("item_level", "size").agg(F.count("*").alias("k")).toPandas()
    for level, h in histogram.sort_values("size").groupby("item_level"):
        capacity, _, sep = budgets[level]
        lengths = h["size"].to_numpy(np.int64)
        out[level] = (lengths, *solve(lengths, h["k"].to_numpy(np.int64), capacity + sep))
    return out


def pack_items(items: DataFrame, budgets: dict[str, tuple[int, int, int]]) -> DataFrame:
    """item_level, item_key, piece_index, token_start, n_tokens, container_id for items (item_level, item_key, n)."""
    sized = sized_items(items, budgets)
    return assigned(sized, solutions(sized, budgets))


def assigned(sized: DataFrame, found: dict[str, tuple[np.ndarray, list[tuple[int, Pattern]], int]]) -> DataFrame:
    """The containers of all items."""
    plans = {level: plan_of(lengths, patterns) for level, (lengths, patterns, _) in found.items()}
    held = sized.sparkSession.sparkContext.broadcast(plans)  # bounded by lengths and patterns
    # rank of an item among those of its length: those of earlier partitions come first
    key = ["part", "item_level", "size"]
    tallies = sized.groupBy(*key).agg(F.count("*").alias("k"))
    before = W.partitionBy("item_level", "size").orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    first = tallies.select(*key, F.coalesce(F.sum("k").over(before), F.lit(0)).alias("first"))
    local = sized.withColumn("nth", F.row_number().over(W.partitionBy(*key).orderBy("item_key")))
    ranked = local.join(first, key).withColumn("rank", F.col("first") + F.col("nth") - 1)

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            b = b.reset_index(drop=True)
            container = np.empty(len(b), dtype=object)
            for (level, size), rows in b.groupby(["item_level", "size"], sort=False).indices.items():
                plan = held.value[level]
                i = int(np.searchsorted(plan.lengths, size))
                rank = b["rank"].to_numpy()[rows]
                j = np.searchsorted(plan.first[i], rank, side="right") - 1
                copy = (rank - plan.first[i][j]) // plan.each[i][j]
                container[rows] = [f"{level}-{p}-{c}" for p, c in zip(plan.pattern[i][j], copy)]
            yield pd.DataFrame({"item_level": b["item_level"], "item_key": b["item_key"], "piece_index": b["full"], "token_start": b["n"] - b["rest"], "n_tokens": b["rest"], "container_id": container})

    schema = "item_level string, item_key string, piece_index int, token_start int, n_tokens int, container_id string"
    placed = ranked.select("item_level", "item_key", "n", "full", "rest", "size", "rank").mapInPandas(place, schema)
    whole = (
        sized.where("full > 0")
        .select("item_level", "item_key", "capacity", F.explode(F.sequence(F.lit(0), F.col("full") - 1)).alias("piece_index"))
        .select(
            "item_level", "item_key", "piece_index", (F.col("piece_index") * F.col("capacity")).cast("int").alias("token_start"), F.col("capacity").alias("n_tokens"),
            F.concat_ws("-", "item_level", F.lit("full"), "item_key", "piece_index").alias("container_id"),
        )
    )
    return placed.unionByName(whole)


def p3_assignments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Container of every item, and of every piece of a larger one."""
    return pack_items(all_items(spark, sf_dir), budget_of(spark, sf_dir, "pack"))


def p3_containers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Containers by level, the least number any packing needs, items and share of the capacity filled."""
    budgets = budget_of(spark, sf_dir, "pack")
    sized = sized_items(all_items(spark, sf_dir), budgets)
    found = solutions(sized, budgets)
    limits = spark.createDataFrame([(k, c, s, found[k][2] if k in found else 0) for k, (c, _, s) in budgets.items()], "item_level string, capacity int, sep int, bound long")
    per = assigned(sized, found).groupBy("item_level", "container_id").agg(F.count("*").alias("k"), F.sum("n_tokens").alias("t"))
    full = F.coalesce(F.regexp_extract("container_id", "^[^-]*-full-", 0) != "", F.lit(False))
    return (
        per.join(F.broadcast(limits), "item_level")
        .withColumn("cost", F.col("t") + F.col("sep") * (F.col("k") - 1))
        .groupBy("item_level", "capacity")
        .agg(
            F.count("*").alias("n_containers"), (F.first("bound") + F.count_if(full)).alias("least_containers"), F.sum("k").alias("n_pieces"), F.max("cost").alias("largest_cost"),
            F.round(F.sum("cost") / (F.count("*") * F.first("capacity")), 4).alias("filled"),
        )
    )


def p3_conserved(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items, pieces and tokens of each level after packing, containers over the capacity, and items whose pieces leave a gap."""
    budgets = budget_of(spark, sf_dir, "pack")
    limits = spark.createDataFrame([(k, c, s) for k, (c, _, s) in budgets.items()], "item_level string, capacity int, sep int")
    placed = cut_lineage(p3_assignments(spark, sf_dir))
    over = placed.groupBy("item_level", "container_id").agg(F.count("*").alias("k"), F.sum("n_tokens").alias("t")).join(F.broadcast(limits), "item_level")
    over = over.groupBy("item_level").agg(F.count_if(F.col("t") + F.col("sep") * (F.col("k") - 1) > F.col("capacity")).alias("n_over"))
    per = placed.groupBy("item_level", "item_key").agg(F.count("*").alias("k"), F.sum("n_tokens").cast("long").alias("t"), F.max(F.col("token_start") + F.col("n_tokens")).alias("end"), F.countDistinct("token_start").alias("starts"))
    sums = per.groupBy("item_level").agg(F.count("*").alias("n_items"), F.sum("k").alias("n_pieces"), F.sum("t").alias("n_tokens"), F.count_if((F.col("t") != F.col("end")) | (F.col("starts") != F.col("k"))).alias("n_gaps"))
    return sums.join(over, "item_level")
