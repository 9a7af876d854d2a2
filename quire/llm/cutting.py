"""Problem 5: cut oversized items at the deepest lexical-cohesion valley inside each size window.

Every text is a run of words; a piece costs 1.3 a word and 0.5 a mark, so the price of any span follows
from two prefix sums and each piece is within its capacity by construction.
Boundaries rank: paragraph end, sentence end, any word end. Within the window that the capacity allows
(its upper half), the candidates of the best rank present compete; the one whose neighbouring blocks share
the least vocabulary, against the peaks on both sides, wins. The next piece then starts early enough to
repeat at most `overlap` tokens.

Defined results: null, empty and blank texts have no words, cost nothing and are never cut; a single word
dearer than half the capacity is cut between characters; repeated rows give one item.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from itertools import accumulate
from math import sqrt

import pandas as pd
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.functions.tokens import MARK_PRICE, WORD_SURCHARGE, proxy_tokens
from quire.llm.items import _key, budget_of, scene_lengths, scene_members
from quire.plans.session import cut_lineage, read_table, small_broadcast

_WORD = regex.compile(r"\S+")
_MARK = regex.compile(r"[^\w\s]")
_SENTENCE_END = re.compile(r"[.!?…][\"'”’»)\]]*$")
#: Sentences on either side of a gap whose vocabularies are compared.
BLOCK = 3


def _spans(text: str, capacity: int) -> list[tuple[int, int]]:
    """Words as character spans; a word too dear for half a piece is cut into runs of characters."""
    most = max(1, int(capacity) - 2)
    spans = []
    for m in _WORD.finditer(text):
        a, b = m.span()
        if b - a > most and len(_MARK.findall(m.group())) * MARK_PRICE + 2 > capacity / 2:
            spans += [(i, min(i + most, b)) for i in range(a, b, most)]
        else:
            spans.append((a, b))
    return spans


def _cosine(a: Counter, b: Counter) -> float:
    dot = sum(n * b[w] for w, n in a.items() if w in b)
    return dot / sqrt(sum(n * n for n in a.values()) * sum(n * n for n in b.values())) if dot else 0.0


def _depths(units: list[Counter]) -> list[float]:
    """Depth of the similarity valley after each unit but the last: the drop from the peaks on both sides."""
    n = len(units) - 1
    sums = [sum(units[max(0, i + 1 - BLOCK) : i + 1], Counter()) for i in range(len(units))]
    ahead = [sum(units[i + 1 : i + 1 + BLOCK], Counter()) for i in range(n)]
    sim = [_cosine(sums[i], ahead[i]) for i in range(n)]
    depths = []
    for i, s in enumerate(sim):
        left = right = s
        j = i
        while j and sim[j - 1] >= left:
            j -= 1
            left = sim[j]
        j = i
        while j + 1 < n and sim[j + 1] >= right:
            j += 1
            right = sim[j]
        depths.append(left + right - 2 * s)
    return depths


def cut_text(text: str | None, capacity: int, overlap: int) -> list[tuple[int, int, int, int]]:
    """(first char, end char, tokens, tokens repeated from the piece before) of each piece."""
    if not text or not text.strip():
        return []
    spans = _spans(text, capacity)
    n = len(spans)
    marks = [0, *accumulate(len(_MARK.findall(text[a:b])) for a, b in spans)]

    def price(s: int, e: int) -> int:
        w = float(e - s)
        return int(w + WORD_SURCHARGE * w + MARK_PRICE * (marks[e] - marks[s]))

    rank, units, bag = [0] * (n + 1), [], Counter()
    ends: list[int] = []
    for i, (a, b) in enumerate(spans):
        word = text[a:b]
        if len(word) > 3:
            bag[word.strip(".,;:!?…\"'“”‘’«»()").lower()] += 1
        gap = text[b : spans[i + 1][0]] if i + 1 < n else ""
        rank[i + 1] = 2 if gap.count("\n") > 1 else 1 if _SENTENCE_END.search(word) else 0
        if rank[i + 1] or i + 1 == n:
            units.append(bag)
            ends.append(i + 1)
            bag = Counter()
    depth = dict(zip(ends, _depths(units))) if len(units) > 1 else {}
    pieces, start, cut = [], 0, 0
    while True:
        if price(start, n) <= capacity:
            pieces.append((start, n, cut))
            break
        lo, hi = cut + 1, n  # the last end that fits
        while lo < hi:
            mid = (lo + hi + 1) // 2
            lo, hi = (mid, hi) if price(start, mid) <= capacity else (lo, mid - 1)
        last = lo
        within = [e for e in range(max(cut + 1, (cut + last) // 2), last + 1) if rank[e]]
        best = max((rank[e] for e in within), default=0)
        end = max((e for e in within if rank[e] == best), key=lambda e: (depth.get(e, 0.0), e)) if within else last
        pieces.append((start, end, cut))
        cut = start = end
        while overlap and start - 1 > pieces[-1][0] and price(start - 1, end) <= overlap:
            start -= 1
    return [(spans[s][0], spans[e - 1][1], price(s, e), price(s, c)) for s, e, c in pieces]


def cut_items(items: DataFrame, budgets: dict[str, tuple[int, int, int]]) -> DataFrame:
    """Pieces of items (item_level, item_key, text), one row each; rows stay where they are, nothing is shuffled.

    An item without text gives one row without piece, so that no item is lost.
    """
    schema = "item_level string, item_key string, piece_index int, n_pieces int, char_start int, char_end int, n_tokens int, overlap_tokens int, text string"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for level, key, text in zip(batch["item_level"], batch["item_key"], batch["text"]):
                capacity, overlap, _ = budgets[level]
                pieces = cut_text(text, capacity, overlap)
                rows += [(level, key, i, len(pieces), a, b, t, o, text[a:b]) for i, (a, b, t, o) in enumerate(pieces)] or [(level, key, 0, 0, 0, 0, 0, 0, None)]
            yield pd.DataFrame(rows, columns=[c.split()[0] for c in schema.split(", ")])

    return items.select("item_level", "item_key", "text").mapInPandas(run, schema)


def oversized(spark: SparkSession, sf_dir: str) -> DataFrame:
    """item_level, item_key, text of the items that count more than the capacity for task cut.

    A scene's text is that of its paragraphs; only paragraphs of oversized scenes are fetched, by a broadcast of their
    keys while those are counted to be few, else by a join.
    """
    budgets = budget_of(spark, sf_dir, "cut")
    paragraphs, scenes, chunks = (read_table(spark, sf_dir, t) for t in ("paragraphs", "scenes", "chunks"))
    items = spark.createDataFrame([], "item_level string, item_key string, text string")
    # paragraphs are read and priced once; of their texts only those of oversized ones are kept
    most = budgets["paragraph"][0] if "paragraph" in budgets else None
    priced = paragraphs.select("book_id", "paragraph_index", proxy_tokens(F.col("text")).alias("n"), F.col("text").alias("t"))
    priced = cut_lineage(priced.select("book_id", "paragraph_index", "n", F.when(F.col("n") > most, F.col("t")).alias("text")))
    if "paragraph" in budgets:
        p = priced.where("text is not null").groupBy("book_id", "paragraph_index").agg(F.max("text").alias("text"))
        items = items.unionByName(p.select(F.lit("paragraph").alias("item_level"), _key("book_id", "paragraph_index").alias("item_key"), "text"))
    if "chunk" in budgets:
        c = chunks.where(proxy_tokens(F.col("text")) > budgets["chunk"][0]).groupBy("id").agg(F.max("text").alias("text"))
        items = items.unionByName(c.select(F.lit("chunk").alias("item_level"), F.coalesce("id", F.lit("")).alias("item_key"), "text"))
    if "scene" in budgets:
        keys = ["book_id", "chapter_index", "scene_index"]
        lengths = priced.groupBy("book_id", "paragraph_index").agg(F.max("n").alias("n"))
        big = scene_lengths(scenes, lengths).where(F.col("n") > budgets["scene"][0]).select(*keys)
        member = cut_lineage(scene_members(scenes).join(big, keys, "left_semi").select(*keys, "paragraph_index"))
        wanted = member.select("book_id", "paragraph_index").distinct()
        texts = paragraphs.join(small_broadcast(wanted, member.count()), ["book_id", "paragraph_index"]).groupBy("book_id", "paragraph_index").agg(F.max("text").alias("text"))
        s = member.join(texts, ["book_id", "paragraph_index"], "left").groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("paragraph_index", "text"))).alias("ps"))  # the paragraphs of one scene
        text = F.array_join(F.transform("ps", lambda x: F.coalesce(x["text"], F.lit(""))), "\n\n")
        items = items.unionByName(s.select(F.lit("scene").alias("item_level"), _key(*keys).alias("item_key"), text.alias("text")))
    return items


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys of the items that were cut; each key once."""
    return p5_pieces(spark, sf_dir).select("item_level", "item_key").distinct()


def p5_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pieces of every oversized item, with their texts."""
    return cut_items(oversized(spark, sf_dir), budget_of(spark, sf_dir, "cut"))


def p5_cover(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where the pieces of each oversized item begin and end, and how many of them are over the capacity."""
    budgets = budget_of(spark, sf_dir, "cut")
    limits = spark.createDataFrame([(k, c) for k, (c, _, _) in budgets.items()], "item_level string, capacity int")
    rows = p5_pieces(spark, sf_dir).join(F.broadcast(limits), "item_level")  # a fixed table of a few rows
    return rows.groupBy("item_level", "item_key").agg(F.min("char_start").alias("first_char"), F.max("char_end").alias("end_char"), F.count_if(F.col("n_tokens") > F.col("capacity")).alias("n_over"))
