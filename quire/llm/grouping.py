"""Problem 6: splits that keep related records together.

Books are nodes, normalised author names, series names and source files are nodes too; a book is joined to each
of its keys, and connected components give the groups. For the splits, the weights of the components (chunks)
are balanced by k-way largest differencing: parts of PART components into BINS bins each, the bins of GATHERED parts
into BINS bins, and so on up a tree until the driver balances the last few; then whole bins go to the splits. Parts
are fixed by hashes and counts, not by how the data happen to be partitioned.

Defined results: null, blank and placeholder names relate nothing; a null book_id is left out of groups and
its chunks get split null; repeated rows count once. A short given name ("W. Duputeld") is the same as the one
full name it fits; where it fits several, it is a name of its own. Short and full names meet on a long word and an
initial; a name of one of each needs only the smallest and largest full name there, so no group of names is gathered.
"""

from __future__ import annotations

import heapq
import re
import unicodedata
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.plans.components import connected_components
from quire.plans.session import cut_lineage, read_table, small_broadcast

#: Names that stand for no name.
PLACEHOLDERS = {
    "", "unknown", "unknown author", "author unknown", "various", "various authors", "anonymous", "anon", "n a", "na", "none", "null", "nil", "root", "tbd", "tba",
    "untitled", "no series", "no author", "standalone", "stand alone", "misc", "miscellaneous", "other", "others", "default", "not available", "undefined", "unbekannt", "anonyme", "anonymus",
    "author", "series", "nan", "unspecified", "not specified", "not applicable", "single", "x", "xx", "xxx",
}
#: Letters that carry no combining mark to strip.
LETTERS = str.maketrans({"ø": "o", "ł": "l", "đ": "d", "ð": "d", "þ": "th", "ß": "ss", "æ": "ae", "œ": "oe", "ı": "i", "ħ": "h"})
#: Articles of series names.
ARTICLES = {"the", "a", "an", "der", "die", "das", "le", "la", "les", "el", "los", "las"}
_NUMBER = r"(?:\d+|[ivxlc]+|one|two|three|four|five|six|seven|eight|nine|ten)"
_VOLUME = re.compile(rf"[\[(,;:–—-]*\s*\b(?:book|bk|vol|volume|part|pt|no|nr|number|band|tome|tomo|teil|episode)s?\b\.?\s*#?\s*{_NUMBER}\b\s*(?:(?:of|/)\s*{_NUMBER}\b)?\s*[\])]?")
_HASH = re.compile(r"[\[(]?\s*#\s*\d+(?:\.\d+)?\s*[\])]?|[\[(]\s*\d+\s*[\])]|[,\s]\s*\d+\s*$")


def _plain(name: str) -> str:
    stripped = "".join(c for c in unicodedata.normalize("NFKD", name.lower().translate(LETTERS)) if not unicodedata.combining(c))
    return stripped.translate(LETTERS)


def author_key(name: str | None) -> str | None:
    """Words of the name, the sorted long ones first, then the short ones marked by a dot; None for no name."""
    if name is None:
        return None
    plain = _plain(name)
    words = re.findall(r"[^\W_]+\.?", re.sub(r"['’`]", "", plain))
    if not words or " ".join(w.strip(".") for w in words) in PLACEHOLDERS:
        return None
    short = [w.strip(".") + "." for w in words if len(w.strip(".")) == 1 or w.endswith(".")]
    long = [w for w in words if len(w) > 1 and not w.endswith(".")]
    return " ".join([*sorted(long), *short]) if long else " ".join(words)


def series_key(name: str | None) -> str | None:
    """Words of the series without article, volume, marks and case; None for no name."""
    if name is None:
        return None
    plain = _HASH.sub(" ", _VOLUME.sub(" ", _plain(name)))
    words = re.findall(r"[^\W_]+", re.sub(r"['’`]", "", plain))
    if " ".join(words) in PLACEHOLDERS:
        return None
    while words and words[0] in ARTICLES:
        words = words[1:]
    while words and words[-1] in ARTICLES:
        words = words[:-1]
    return None if " ".join(words) in PLACEHOLDERS else " ".join(words)


def fits(short: str, full: str) -> bool:
    """Whether a form with shortened words stands for a full one: its long words are there, and each short one begins another word."""
    rest = full.split()
    for w in (w for w in short.split() if not w.endswith(".")):
        if w not in rest:
            return False
        rest.remove(w)
    for s in (w[:-1] for w in short.split() if w.endswith(".")):
        hit = next((w for w in rest if w.startswith(s)), None)
        if hit is None:
            return False
        rest.remove(hit)
    return True


def resolved(forms: DataFrame) -> DataFrame:
    """form, to: short forms (column form) with the full form they fit, if it is the only one."""

    @F.pandas_udf("boolean")
    def fit(short: pd.Series, full: pd.Series) -> pd.Series:
        return pd.Series([fits(a, b) for a, b in zip(short, full)], dtype=bool)

    words = F.split("form", " ")
    dotted = lambda w: w.endswith(".")
    f = forms.select("form", F.filter(words, lambda w: ~dotted(w)).alias("long"), F.filter(words, dotted).alias("short")).where("size(long) > 0").distinct()
    # a full form meets on each of its words with the initial of each other
    pairs = F.explode(F.transform(F.sequence(F.lit(0), F.size("long") - 1), lambda i: F.struct(F.element_at("long", i + 1).alias("w"), i.alias("i"))))
    full = f.where("size(short) = 0 and size(long) > 1").select("form", "long", pairs.alias("a"))
    full = full.select("form", F.explode(F.array_distinct(F.transform(F.filter("long", lambda w, j: j != F.col("a.i")), lambda w: F.concat_ws("|", F.col("a.w"), F.substring(w, 1, 1))))).alias("at"))
    full = cut_lineage(full.distinct())
    wanted = f.where("size(short) > 0").withColumn("at", F.concat_ws("|", F.element_at("long", 1), F.substring(F.element_at("short", 1), 1, 1)))
    plain = F.expr("size(long) = 1 and size(short) = 1 and length(short[0]) = 2")
    ends = full.groupBy("at").agg(F.min("form").alias("to"), F.max("form").alias("other"))
    simple = wanted.where(plain).select("form", "at").join(ends, "at").select("form", "to", "other")
    rest = wanted.where(~plain).select("form", "at").join(full.select("at", F.col("form").alias("full")), "at").where(fit("form", "full")).groupBy("form").agg(F.min("full").alias("to"), F.max("full").alias("other"))
    return simple.unionByName(rest).where("to = other").select("form", "to")


def _author_names(books: DataFrame) -> DataFrame:
    """author (raw), key: the raw spelling's resolved name."""

    @F.pandas_udf("string")
    def key_of(names: pd.Series) -> pd.Series:
        return names.map(author_key)

    raw = cut_lineage(books.select("author").where("author is not null").distinct().withColumn("form", key_of("author")).where("form is not null"))
    return raw.join(resolved(raw.select("form")), "form", "left").select("author", F.coalesce("to", "form").alias("key"))


def book_keys(books: DataFrame) -> DataFrame:
    """u (book), v (name or file) edges; books carry prefix 0 and keys prefix 1, so that a group's smallest node is a book."""

    @F.pandas_udf("string")
    def series_of(names: pd.Series) -> pd.Series:
        return names.map(series_key)

    b = books.select("book_id", "author", "series", "sources").where("book_id is not null")
    authors = b.join(_author_names(b), "author").select("book_id", F.concat(F.lit("1a:"), "key").alias("v"))
    names = b.select("series").where("series is not null").distinct().withColumn("key", series_of("series")).where("key is not null")
    series = b.join(names, "series").select("book_id", F.concat(F.lit("1s:"), "key").alias("v"))
    files = b.select("book_id", F.explode("sources").alias("f")).where("trim(f) <> ''").select("book_id", F.concat(F.lit("1f:"), F.trim("f")).alias("v"))
    own = b.select("book_id", F.concat(F.lit("0"), "book_id").alias("v"))
    return authors.unionByName(series).unionByName(files).unionByName(own).select(F.concat(F.lit("0"), "book_id").alias("u"), "v").distinct()


def book_groups(books: DataFrame) -> DataFrame:
    """book_id, group_id (smallest book_id of the group) for every book."""
    found = connected_components(book_keys(books))
    return found.where("node like '0%'").select(F.expr("substring(node, 2)").alias("book_id"), F.expr("substring(component, 2)").alias("group_id"))


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """group_id, book_id for each other member of a group of two or more."""
    return book_groups(read_table(spark, sf_dir, "book_specs")).where("group_id < book_id").select("group_id", "book_id")


#: Bins of each balancing step, components of a part, parts whose bins are balanced together.
BINS, PART, GATHERED = 128, 200_000, 64


def largest_differencing(weights: list[tuple[int, object]], bins: int) -> list[tuple[int, list]]:
    """(weight, members) of `bins` bins: the two partitions of largest spread are merged, heavy bins onto light ones.

    Ties fall to the order of the input, so the result is fixed by it.
    """
    heap = []
    for i, (w, m) in enumerate(sorted(weights, key=lambda x: (-x[0], str(x[1])))):
        heapq.heappush(heap, (-w, i, {0: (w, [m])}))
    n = len(heap)
    while len(heap) > 1:
        _, _, a = heapq.heappop(heap)
        _, _, b = heapq.heappop(heap)
        # a and b are sparse: bin -> (weight, members); bins that are absent weigh 0
        x = sorted(a.values(), key=lambda t: -t[0])
        y = sorted(b.values(), key=lambda t: -t[0])
        x += [(0, [])] * (min(bins, len(x) + len(y)) - len(x))
        y += [(0, [])] * (len(x) - len(y))
        merged = sorted(((p[0] + q[0], p[1] + q[1]) for p, q in zip(x, reversed(y))), key=lambda t: -t[0])
        least = merged[-1][0] if len(merged) == bins else 0
        n += 1
        heapq.heappush(heap, (-(merged[0][0] - least), n, dict(enumerate(merged))))
    got = list(heap[0][2].values()) if heap else []
    return got + [(0, [])] * (bins - len(got))


def binned(rows: DataFrame, parts: int) -> DataFrame:
    """id, bin, bin_w: rows (id, w) of each part in BINS bins."""

    def local(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        got = [(int(w), g) for b in batches for g, w in zip(b["id"], b["w"])]
        out = [(g, f"{part}-{i}", w) for i, (w, gs) in enumerate(largest_differencing(got, BINS)) for g in gs]
        yield pd.DataFrame(out, columns=["id", "bin", "bin_w"])

    return cut_lineage(rows.repartition(parts, "id").sortWithinPartitions("id").mapInPandas(local, "id string, bin string, bin_w long"))


def spread(comps: DataFrame, plan: dict[str, float]) -> DataFrame:
    """group_id, split: whole bins of components (group_id, w) to the split that lacks most of its share, heavy bins first."""
    levels = []
    rows, n = comps.select(F.col("group_id").alias("id"), "w"), comps.count()
    parts = -(-n // PART) or 1
    while True:
        level = binned(rows, parts)
        levels.append(level)
        if parts == 1:
            break
        rows, parts = level.select(F.col("bin").alias("id"), F.col("bin_w").alias("w")).distinct(), -(-parts // GATHERED)
    bins = sorted((-r["bin_w"], r["bin"]) for r in levels[-1].select("bin", "bin_w").distinct().collect())  # at most BINS
    need = {s: f * -sum(w for w, _ in bins) for s, f in plan.items()}
    chosen = []
    for w, b in bins:
        split = max(sorted(need), key=lambda s: need[s])
        need[split] += w
        chosen.append((b, split))
    to = comps.sparkSession.createDataFrame(chosen, "bin string, split string")
    for level in reversed(levels):
        rows = to.count()
        to = level.join(small_broadcast(to, rows), "bin").select("id", "split")
        if level is not levels[0]:
            to = to.withColumnRenamed("id", "bin")
    return to.withColumnRenamed("id", "group_id")


def assign_splits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """id, book_id, group_id, split of every chunk."""
    chunks = read_table(spark, sf_dir, "chunks").select("id", "book_id").distinct()
    plan = {r["split"]: float(r["fraction"]) for r in read_table(spark, sf_dir, "split_plan").collect()}
    groups = book_groups(read_table(spark, sf_dir, "book_specs"))
    sizes = chunks.where("book_id is not null").groupBy("book_id").agg(F.count("*").alias("n"))
    weights = sizes.join(groups, "book_id", "left").withColumn("group_id", F.coalesce("group_id", "book_id"))
    comps = weights.groupBy("group_id").agg(F.sum("n").alias("w"))

    to = spread(cut_lineage(comps), plan)
    books = weights.join(to, "group_id").select("book_id", "group_id", "split")
    return chunks.join(books, "book_id", "left").select("id", "book_id", "group_id", "split")


def p6_splits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The new split of every chunk."""
    return assign_splits(spark, sf_dir)


def p6_balance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chunks, books and groups of each split."""
    return assign_splits(spark, sf_dir).groupBy("split").agg(F.count("*").alias("n_chunks"), F.countDistinct("book_id").alias("n_books"), F.countDistinct("group_id").alias("n_groups"))


def p6_books(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chunks of each book, and the splits they got: one."""
    return assign_splits(spark, sf_dir).where("book_id is not null").groupBy("book_id").agg(F.countDistinct("id").alias("n_chunks"), F.countDistinct("split").alias("n_splits"))
