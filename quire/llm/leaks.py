"""Problem 8: evaluation passages inside training documents, by a block-max WAND index of the test items.

The passages are indexed by runs of TERM words; each posting holds its BM25 impact divided by the passage's own
score, so a full copy scores about 1 and one threshold serves all passages. Postings are in passage order, in
blocks that know their largest impact. Every document is a query: its runs that the index knows drive WAND,
which skips whole blocks that cannot lift a passage over the threshold. What it retrieves is verified on the
words: stretches along one diagonal, single changed words allowed, at most two of them, in order. Around the
stretches of a leak the item's question and answer are looked for, in order and in unbroken text, and the leak is
classed by what stands there: the passage alone, with its question, with its answer, or with both.

The index is built in blocks of ITEM_BLOCK passages, each broadcast within that size; more items mean more passes.

Defined results: null, empty and wordless texts and passages match nothing; items with one passage all count;
repeated rows give one pair; passages shorter than TERM words are compared whole as one term.
"""

from __future__ import annotations

import html
import re
from bisect import bisect_left
from collections import Counter, defaultdict
from collections.abc import Iterator
from functools import reduce
from math import log

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.plans.session import read_table

#: Words a term; passages a block of postings; passages an index; BM25's k1 and b; score and share of words needed.
TERM, POSTINGS, ITEM_BLOCK, K1, B, THRESHOLD, SHARE = 5, 16, 20_000, 1.2, 0.75, 0.03, 0.4
#: Matched words a stretch needs (two phrases of everyday language are no leak), or this share of a short passage; what a changed word costs in matched ones.
STRETCH, PART, CHANGED = 10, 0.2, 4
#: Words around a stretch in which question and answer are looked for; share of the question's words that must stand there in order.
NEAR, ASKED = 80, 0.8
_TAG = re.compile(r"<[^<>]*>|\]\([^)\s]*\)")
_WORD = re.compile(r"[^\W_]+")


def words_of(text: str | None) -> list[str]:
    """Words without case, punctuation, spacing and mark-up."""
    if not text:
        return []
    if "<" in text or "](" in text:
        text = _TAG.sub(" ", text)
    if "&" in text:
        text = html.unescape(text)
    return _WORD.findall(text.replace("­", "").lower())


def terms_of(words: list[str], size: int = TERM) -> list[tuple[str, ...]]:
    return list(zip(*(words[i:] for i in range(size)))) if len(words) >= size else ([tuple(words)] if words else [])


class ItemIndex:
    """Inverted index of passages with block maxima."""

    def __init__(self, passages: list[list[str]]):
        self.words = passages
        counts = [Counter(terms_of(w)) for w in passages]
        mean = sum(sum(c.values()) for c in counts) / max(1, len(counts)) or 1
        df = Counter(t for c in counts for t in c)
        idf = {t: log(1 + (len(counts) - n + 0.5) / (n + 0.5)) for t, n in df.items()}
        lists: dict = defaultdict(list)
        for d, c in enumerate(counts):
            size = K1 * (1 - B + B * sum(c.values()) / mean)
            impact = {t: idf[t] * n * (K1 + 1) / (n + size) for t, n in c.items()}
            own = sum(impact.values()) or 1.0
            for t, x in impact.items():
                lists[t].append((d, x / own))
        #: term -> (passages, impacts, last passage of each block, largest impact of each block, largest impact)
        self.lists = {}
        for t, p in lists.items():
            blocks = [p[i : i + POSTINGS] for i in range(0, len(p), POSTINGS)]
            self.lists[t] = ([d for d, _ in p], [x for _, x in p], [b[-1][0] for b in blocks], [max(x for _, x in b) for b in blocks], max(x for _, x in p))
        #: for the few passages shorter than a term
        self.sizes = sorted({len(t) for t in self.lists if len(t) < TERM})

    def query(self, terms: set, threshold: float = THRESHOLD) -> list[int]:
        """Passages that score the threshold or more, by block-max WAND over the lists of the terms."""
        cursors = [[lst[0][0], 0, lst] for t in terms if (lst := self.lists.get(t))]
        found, n = [], len(self.words)
        while cursors:
            cursors.sort(key=lambda c: c[0])
            bound, pivot = 0.0, -1
            for i, c in enumerate(cursors):
                bound += c[2][4]
                if bound >= threshold:
                    pivot = i
                    break
            if pivot < 0:
                break
            doc = cursors[pivot][0]
            while pivot + 1 < len(cursors) and cursors[pivot + 1][0] == doc:
                pivot += 1
            # block maxima at the pivot passage
            best, until = 0.0, n
            for c in cursors[: pivot + 1]:
                b = bisect_left(c[2][2], doc)
                if b < len(c[2][2]):
                    best += c[2][3][b]
                    until = min(until, c[2][2][b] + 1)
            if best < threshold:
                to = max(doc + 1, min(until, cursors[pivot + 1][0] if pivot + 1 < len(cursors) else n))
                moved = cursors[: pivot + 1]
            elif cursors[0][0] == doc:
                if sum(c[2][1][c[1]] for c in cursors[: pivot + 1]) >= threshold:
                    found.append(doc)
                to, moved = doc + 1, cursors[: pivot + 1]
            else:
                to, moved = doc, [c for c in cursors[:pivot] if c[0] < doc]
            for c in moved:
                c[1] = bisect_left(c[2][0], to, c[1])
                c[0] = c[2][0][c[1]] if c[1] < len(c[2][0]) else n
            cursors = [c for c in cursors if c[0] < n]
        return found


def stretches(passage: list[str], words: list[str], at: dict[tuple[str, ...], list[int]]) -> list[tuple[int, int, int, int]]:
    """(first, end) in the passage, first in the document, matched words: the runs along each diagonal of most matches less CHANGED for each changed word, none next to another."""
    diagonals: dict[int, list[int]] = defaultdict(list)
    for i, t in enumerate(terms_of(passage)):
        for j in at.get(t, ()):
            diagonals[j - i].append(i)
    out = []
    size = min(TERM, len(passage))
    for d, starts in diagonals.items():
        lo, hi = max(0, -d), min(len(passage), len(words) - d)
        end = -1
        for i in starts:
            if i < end:
                continue
            a = _reach(passage, words, d, i - 1, lo - 1, -1) + 1
            e = _reach(passage, words, d, i + size, hi, 1)
            end = e
            out.append((a, e, a + d, sum(passage[k] == words[k + d] for k in range(a, e))))
    return out


def _reach(passage: list[str], words: list[str], d: int, at: int, stop: int, step: int) -> int:
    """Where a run that holds up to `at` ends in one direction: behind its best-scoring extension, or at the edge when one change lies between and two words or more behind it match."""
    best, score, high, changed, since, changes = at, 0, 0, False, 0, 0
    while at != stop:
        if passage[at] == words[at + d]:
            score, changed, since = score + 1, False, since + 1
            if score > high:
                high, best, changes = score, at + step, 0
        else:
            score -= CHANGED
            if changed or score < high - 2 * CHANGED:
                break
            changed, since, changes = True, 0, changes + 1
        at += step
    return at if at == stop and since > 1 and changes == 1 else best


def overlap(passage: list[str], words: list[str], at: dict[tuple[str, ...], list[int]]) -> tuple[float, list[tuple[int, int]]]:
    """(share of the passage's words in the best one or two stretches that stand in order, where these lie in the document)."""
    need = min(STRETCH, max(TERM + 1, int(PART * len(passage))), len(passage))
    runs = sorted(r for r in stretches(passage, words, at) if r[3] >= need)
    best, spans = 0, []
    for a, e, j, n in runs:
        if n > best:
            best, spans = n, [(j, j + e - a)]
    for x, (a, e, j, n) in enumerate(runs):
        for b, f, k, m in runs[x + 1 :]:
            if k >= j + (e - a) and f > e and (both := n + m - max(0, e - b)) > best:  # a later stretch that overlaps in the passage counts its rest
                best, spans = both, [(j, j + e - a), (k, k + f - b)]
    return (best / len(passage) if passage else 0.0), spans


def in_order(words: list[str], text: list[str]) -> int:
    """Length of the longest common subsequence, bit-parallel over text."""
    at: dict[str, int] = {}
    for i, w in enumerate(text):
        at[w] = at.get(w, 0) | 1 << i
    full = (1 << len(text)) - 1
    v = full
    for w in words:
        u = v & at.get(w, 0)
        v = (v + u | v - u) & full
    return len(text) - v.bit_count()


def around(words: list[str], spans: list[tuple[int, int]]) -> list[list[str]]:
    """The pieces of a document within NEAR words of its stretches, without these."""
    free = set()
    for a, b in spans:
        free |= set(range(max(0, a - NEAR), min(len(words), b + NEAR)))
    for a, b in spans:
        free -= set(range(a, b))
    pieces: list[list[str]] = []
    last = None
    for i in sorted(free):
        if last is None or i != last + 1:
            pieces.append([])
        pieces[-1].append(words[i])
        last = i
    return pieces


def asked(question: list[str], pieces: list[list[str]]) -> float:
    """Largest share of the question's words that stand in order within a window of twice its length."""
    if not question:
        return 0.0
    best = 0
    for p in pieces:
        for i in range(0, max(1, len(p) - len(question) + 1), max(1, len(question) // 2)):
            best = max(best, in_order(question, p[i : i + 2 * len(question)]))
    return best / len(question)


def answered(answer: list[str], pieces: list[list[str]]) -> bool:
    """Whether the answer stands somewhere as a phrase."""
    n = len(answer)
    return n > 0 and any(p[i : i + n] == answer for p in pieces for i in range(len(p) - n + 1))


def find_leaks(docs: DataFrame, items: DataFrame, share: float = SHARE) -> DataFrame:
    """doc_id, item_id, share of the passage, question_share and has_answer near it, kind for every document and item it leaks.

    kind is passage, passage+question, passage+answer or passage+question+answer.
    """
    spark = docs.sparkSession
    rows = items.select("item_id", "passage", "question", "answer").dropDuplicates(["item_id"]).orderBy("item_id")
    local = rows.toPandas()  # the held-out items: a fixed table, worked in blocks of ITEM_BLOCK passages
    schema = "doc_id long, item_id long, share double, question_share double, has_answer boolean, kind string"
    parts = []
    grouped = defaultdict(list)
    for r in local.itertuples():
        words = words_of(r.passage)
        if words:
            grouped[tuple(words)].append((int(r.item_id), words_of(r.question), words_of(r.answer)))
    passages = list(grouped.items())
    for start in range(0, max(1, len(passages)), ITEM_BLOCK):
        block = passages[start : start + ITEM_BLOCK]
        held = spark.sparkContext.broadcast((ItemIndex([list(p) for p, _ in block]), [x for _, x in block]))

        def run(batches: Iterator[pd.DataFrame], held=held) -> Iterator[pd.DataFrame]:
            index, members = held.value
            lists, sizes = index.lists, index.sizes
            for batch in batches:
                out = []
                for doc_id, text in zip(batch["doc_id"], batch["text"]):
                    words = words_of(text)
                    hits = lists.keys() & set(terms_of(words))
                    for size in sizes:
                        hits.update(t for t in terms_of(words, size) if t in lists)
                    if not hits:
                        continue
                    found = index.query(hits)
                    if not found:
                        continue
                    at: dict = defaultdict(list)
                    for size in {TERM, *sizes}:
                        for j, t in enumerate(terms_of(words, size)):
                            if t in hits:
                                at[t].append(j)
                    for d in found:
                        got, spans = overlap(index.words[d], words, at)
                        if got >= share:
                            near = around(words, spans)
                            for item, question, answer in members[d]:
                                q, has = asked(question, near), answered(answer, near)
                                out.append((doc_id, item, got, q, has, "passage" + "+question" * (q >= ASKED) + "+answer" * has))
                yield pd.DataFrame(out, columns=["doc_id", "item_id", "share", "question_share", "has_answer", "kind"])

        parts.append(docs.select("doc_id", "text").where("text is not null").mapInPandas(run, schema))
    return reduce(DataFrame.unionByName, parts)


def p8_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, item_id, once each."""
    return p8_leaks(spark, sf_dir).select("doc_id", "item_id").distinct()


def p8_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pairs with the share of the passage, what stands near it of question and answer, and the kind of leak that makes."""
    return find_leaks(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "heldout_items"))


def p8_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that leak each item, items without any included."""
    items = read_table(spark, sf_dir, "heldout_items").select("item_id", "suite").dropDuplicates(["item_id"])
    per = p8_leaks(spark, sf_dir).groupBy("item_id").agg(
        F.countDistinct("doc_id").alias("n_docs"), F.round(F.max("share"), 4).alias("largest_share"), *[F.countDistinct(F.when(F.col("kind").contains(k), F.col("doc_id"))).alias(f"n_with_{k}") for k in ("question", "answer")]
    )
    zero = lambda c: F.coalesce(c, F.lit(0)).alias(c)
    return items.join(per, "item_id", "left").select("item_id", "suite", zero("n_docs"), zero("n_with_question"), zero("n_with_answer"), "largest_share")
