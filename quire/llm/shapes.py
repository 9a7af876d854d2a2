"""Problem 9: keyword-stuffed and link-list pages by the shapes of their units.

A page is cut into units: lines, and within a line sentences. Each unit is reduced to a shape: steps of its word
count, of the shares of capitals, short words, repeated words and links, of separators and of the words between them,
and of signs, prices and closing marks. Whole batches of pages are reduced at once, by arrays over their characters.

The shapes of all pages are grouped: one row a shape holds what its units are like over the whole corpus, and these
means, not a single unit, say whether a shape is a list (`verdicts`). The number of shapes is bounded by the number of
codes, whatever the data. A page is flagged when list shapes hold more than SHARE of its words, counting the FEW that
hold most of them: few non-sentence shapes dominate it.

Short words of small letters stand for the function words of any language; there is no list of words.

Defined results: null, empty, blank and wordless texts are never flagged; every row is judged by itself, so
repeated rows give the same doc_id, which comes out once; pages are never cut short.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.plans.session import cut_lineage, read_table

#: Share of a page's words in list shapes from which it is flagged; shapes that may make up the dominating share.
SHARE, FEW = 0.5, 12
#: Characters that are reduced at once; a longer page is a batch of its own.
AT_ONCE = 1 << 20
#: Letters up to which a word is short; times that a word comes back on its page, and its least share of the page, to be a keyword.
SHORT, BACK, DENSE = 3, 4, 1 / 60
#: Share of keywords on a page below which it has none: text about a matter repeats its names that often.
STUFFED = 0.25
# Characters by what they do in a unit.
SEPARATORS, CRUMBS, MONEY, ENDS, CLOSERS, JOINERS = ",;|·•/", "»>›→", "$€£¥", ".!?…", "\"”’»)]", "-'’"
LINES = "\n\r\x0b\x0c  "
# ----------------------------------------------------------
_URL = re.compile(r"(?:https?://|www\.)\S+|\b[\w-]+(?:\.[\w-]+)+/\S*|<a\b[^>]*>|\]\([^)\s]*\)", re.I)
_TAG = re.compile(r"</?[a-zA-Z][^>]*>")
_LINKED = re.compile(r"https?:|www\.|<a\b|\]\(", re.I)
ALNUM, UPPER, SPACE, LINE, SEP, HASH, CRUMB, CASH, END, CLOSE, JOIN, LATIN, DIGIT, STOP = (1 << i for i in range(14))
_TABLE = 0x20000


@cache
def _classes() -> tuple[np.ndarray, np.ndarray]:
    """(what each code point is, its small letter)."""
    flags, small = np.zeros(_TABLE, np.uint16), np.arange(_TABLE, dtype=np.uint32)
    for i in range(_TABLE):
        c = chr(i)
        if c.isspace():
            flags[i] = SPACE
        elif c.isalnum():
            flags[i] = ALNUM | UPPER * c.isupper() | DIGIT * c.isdigit() | LATIN * (i < 0x250 and c.isalpha())
            if len(c.lower()) == 1:
                small[i] = ord(c.lower())
    for signs, flag in ((SEPARATORS, SEP), ("#", HASH), (CRUMBS, CRUMB), (MONEY, CASH), (ENDS, END), (CLOSERS, CLOSE), (JOINERS, JOIN), (LINES, LINE | SPACE), (".", STOP)):
        for c in signs:
            flags[ord(c)] |= flag
    return flags, small


@cache
def _powers(n: int) -> np.ndarray:
    """Odd factors of the places in a word; later places have the last one's."""
    odd = np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return (odd ^ odd >> np.uint64(31)) | np.uint64(1)


def _hash_of(word: str) -> int:
    return int(_word_hashes(np.array([ord(c) for c in word], np.uint32), np.array([0]), np.array([len(word)]))[0])


def _word_hashes(small: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Hash of each word from its small letters; small holds the letters of the words one after the other."""
    if not len(start):
        return np.empty(0, np.uint64)
    place = np.arange(len(small)) - np.repeat(start, length)
    mixed = (small.astype(np.uint64) + np.uint64(1)) * _powers(64)[np.minimum(place, 63)]
    total = np.add.reduceat(mixed ^ mixed >> np.uint64(29), start) * np.uint64(0xBF58476D1CE4E5B9)
    return total ^ total >> np.uint64(31)


#: Marks of a product line besides currency signs.
PRODUCT = ("sku", "isbn", "eur", "usd", "gbp")


def _before(x: np.ndarray) -> np.ndarray:
    return np.concatenate([[False], x[:-1]])


def _after(x: np.ndarray) -> np.ndarray:
    return np.concatenate([x[1:], [False]])


class Units:
    """Measures of the units of a batch of pages, an array each; page says whose each unit is."""

    def __init__(self, texts: list[str]):
        flags_of, small_of = _classes()
        sizes = np.array([len(t) + 1 for t in texts])
        whole = "\n".join(texts) + "\n"
        code = np.frombuffer(whole.encode("utf-32-le", "surrogatepass"), np.uint32)
        known = np.minimum(code, _TABLE - 1)
        flag = np.where(code < _TABLE, flags_of[known], np.uint16(ALNUM))
        page = np.repeat(np.arange(len(texts), dtype=np.int32), sizes)
        flag, link_at = self._without_links(texts, sizes, flag)
        has = lambda f: flag & f != 0
        # units begin at line ends and at white space behind a closing mark
        ended = has(END)
        for _ in range(3):
            ended = ended | has(CLOSE) & _before(ended)
        unit = np.cumsum(has(LINE) | has(SPACE) & _before(ended), dtype=np.int32)
        n_units = int(unit[-1]) + 1
        count = lambda mask: np.bincount(unit[mask], minlength=n_units)
        self.page = np.zeros(n_units, np.int64)
        self.page[unit] = page  # a line end opens the unit after it, so the last character tells
        # words: letters and digits, with single joiners inside
        alnum = has(ALNUM)
        inside = alnum | has(JOIN) & _before(alnum) & _after(alnum)
        start = np.flatnonzero(inside & ~_before(inside))
        stop = np.flatnonzero(inside & ~_after(inside)) + 1
        length = stop - start
        self.n = np.bincount(unit[start], minlength=n_units)
        letters = small_of[known[inside]] if len(start) else np.empty(0, np.uint32)
        first = np.concatenate([[0], np.cumsum(length)[:-1]]).astype(np.int64) if len(start) else np.empty(0, np.int64)
        word = _word_hashes(letters, first, length)
        upper = flag[start] & UPPER != 0
        short = (length <= SHORT) & ~upper & (flag[start] & DIGIT == 0)
        self.capital, self.short = np.bincount(unit[start[upper]], minlength=n_units), np.bincount(unit[start[short]], minlength=n_units)
        self.latin = np.bincount(unit[start[flag[start] & LATIN != 0]], minlength=n_units)
        self.links = np.bincount(unit[link_at], minlength=n_units)
        self.tags, self.tokens = count(has(HASH)), count(~has(SPACE) & _before(has(SPACE)))
        self.crumbs = count(has(CRUMB) & _before(has(SPACE)) & _after(has(SPACE)))
        digit, cash = has(DIGIT), has(CASH)
        near = cash & (_after(digit) | _after(has(SPACE) & _after(digit)) | _before(digit))
        marks = np.isin(word, _product_marks())
        self.price = count(near) + np.bincount(unit[start[marks]], minlength=n_units)
        last = np.zeros(n_units, np.int64)
        solid = np.flatnonzero(~has(SPACE))
        last[unit[solid]] = solid
        self.ends = ended[last]
        # items between separators that white space follows, and bars and dots between blanks
        item_end = has(SEP) & _after(has(SPACE))
        item = np.cumsum(item_end | np.concatenate([[False], unit[1:] != unit[:-1]]), dtype=np.int32)
        self._items(item[start], unit[start], word, n_units)
        self._keywords(page[start], unit[start], word, len(texts), n_units)

    def _without_links(self, texts: list[str], sizes: np.ndarray, flag: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(flags with links and mark-up as blanks, where links begin)."""
        begin = np.cumsum(sizes) - sizes
        # a stop inside a word may be a site's name
        dotted = np.flatnonzero((flag & STOP != 0) & _before(flag & ALNUM != 0) & _after(flag & ALNUM != 0))
        dotted = set(np.searchsorted(begin, dotted, side="right").tolist())
        at = []
        for i, t in enumerate(texts):
            if i + 1 in dotted or _LINKED.search(t):
                for m in _URL.finditer(t):
                    at.append(begin[i] + m.start())
                    flag[begin[i] + m.start() : begin[i] + m.end()] = SPACE
            if "<" in t:
                for m in _TAG.finditer(t):
                    flag[begin[i] + m.start() : begin[i] + m.end()] = SPACE
        return flag, np.array(at, np.int64)

    def _items(self, item: np.ndarray, unit: np.ndarray, word: np.ndarray, n_units: int) -> None:
        """items: those with words; longest: words of the longest; alike: share of items that open like another or stand twice."""
        self.items, self.longest, self.alike = np.zeros(n_units, np.int64), np.zeros(n_units, np.int64), np.zeros(n_units)
        if not len(item):
            return
        at = np.flatnonzero(np.concatenate([[True], item[1:] != item[:-1]]))
        size, owner = np.diff(np.append(at, len(item))), unit[at]
        self.items = np.bincount(owner, minlength=n_units)
        np.maximum.at(self.longest, owner, size)
        place = np.arange(len(item)) - np.repeat(at, size)
        both = np.add.reduceat(word * _powers(64)[np.minimum(place, 63)], at)
        for key, most in ((word[at], 0.5), (both, 0.75)):
            distinct = np.unique(np.stack([owner.astype(np.uint64), key]), axis=1)[0].astype(np.int64)
            few = np.bincount(distinct, minlength=n_units) <= most * self.items
            self.alike[few & (self.items > 0)] = 1

    def _keywords(self, page: np.ndarray, unit: np.ndarray, word: np.ndarray, n_pages: int, n_units: int) -> None:
        """again: words of the unit that the page, or the unit itself, repeats without end."""
        self.again = np.zeros(n_units, np.int64)
        if not len(word):
            return
        total = np.bincount(page, minlength=n_pages)

        def times(owner: np.ndarray) -> np.ndarray:
            order = np.lexsort((word, owner))
            o, w = owner[order], word[order]
            new = np.concatenate([[True], (o[1:] != o[:-1]) | (w[1:] != w[:-1])])
            group = np.cumsum(new) - 1
            out = np.empty(len(word), np.int64)
            out[order] = np.bincount(group)[group]
            return out

        back = times(page)
        # of a long page's many keywords each is rare, but comes back within its unit
        hit = (back >= BACK) & ((back >= DENSE * total[page]) | (times(unit) >= BACK - 1))
        stuffed = np.bincount(page[hit], minlength=n_pages) >= STUFFED * total
        self.again = np.bincount(unit[hit & stuffed[page]], minlength=n_units)

    def weight(self) -> np.ndarray:
        return self.n + 2 * self.links


@cache
def _product_marks() -> np.ndarray:
    return np.array([_hash_of(w) for w in PRODUCT], np.uint64)


#: Steps of each measure; a shape is the tuple of its steps, and there are no more shapes than such tuples.
STEPS: dict[str, list[float]] = {
    "words": [1, 2, 5, 9, 17, 61], "capitals": [0.05, 0.3, 0.5], "short": [0.12, 0.2, 0.25], "keywords": [0.3, 0.6], "links": [0.005, 0.1], "tags": [0.2, 0.34], "crumbs": [2], "prices": [0.005, 1 / 14],
    "items": [5, 8], "longest": [7, 10], "item_words": [4.001], "alike": [0.5], "ends": [0.5], "latin": [0.5],
}
MEASURES = list(STEPS)


def measures(u: Units) -> dict[str, np.ndarray]:
    """What is stepped, and averaged over the corpus by shape."""
    n, weight = np.maximum(u.n, 1), np.maximum(u.weight(), 1)
    tagged = np.where(u.tags > 2, np.minimum(u.tags / np.maximum(u.tokens, 1), 2 * u.tags / n), 0)
    return {
        "words": u.n, "capitals": u.capital / n, "short": u.short / n, "keywords": u.again / n, "links": u.links / np.maximum(u.n, u.links * 0.1 + 1), "tags": tagged, "crumbs": u.crumbs, "prices": u.price / n,
        "items": u.items, "longest": u.longest, "item_words": u.n / np.maximum(u.items, 1), "alike": u.alike, "ends": u.ends.astype(float), "latin": u.latin / n, "weight": weight,
    }


def shapes_of(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(page, shape, weight, measures) of every unit with words or links."""
    u = Units(texts)
    m = measures(u)
    code = np.zeros(len(u.page), np.int64)
    for name, steps in STEPS.items():
        code = code * (len(steps) + 1) + np.searchsorted(steps, m[name], side="right")
    kept = u.weight() > 0
    return u.page[kept], code[kept], u.weight()[kept], np.stack([m[name][kept] for name in MEASURES])


def spelled(code: int) -> str:
    """A shape in letters: a step for each measure."""
    out = []
    for name, steps in reversed(STEPS.items()):
        code, step = divmod(code, len(steps) + 1)
        if step:
            out.append(f"{name}{step}")
    return " ".join(reversed(out))


def slices(texts: list[str], most: int = AT_ONCE) -> Iterator[tuple[int, int]]:
    """Runs of texts that have at most so many characters together, or are one text."""
    start = size = 0
    for i, t in enumerate(texts):
        if i > start and size + len(t) > most:
            yield start, i
            start, size = i, 0
        size += len(t)
    if texts:
        yield start, len(texts)


def page_shapes(docs: DataFrame) -> DataFrame:
    """doc_id, shapes, weights, sums: the distinct shapes of each row, the words in them, and sums of their measures over units."""
    schema = "doc_id long, shapes array<long>, weights array<long>, units array<long>, sums array<array<float>>"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            texts = [t or "" for t in b["text"]]
            out = []
            for start, stop in slices(texts):
                page, code, weight, values = shapes_of(texts[start:stop])
                order = np.lexsort((code, page))
                page, code, weight, values = page[order], code[order], weight[order], values[:, order]
                at = np.flatnonzero(np.concatenate([[True], (page[1:] != page[:-1]) | (code[1:] != code[:-1])])) if len(page) else np.empty(0, np.int64)
                if len(at):
                    sums = np.add.reduceat(values, at, axis=1).T.astype(np.float32)
                    weights, units, page, code = np.add.reduceat(weight, at), np.diff(np.append(at, len(page))), page[at], code[at]
                else:
                    sums, weights, units = np.empty((0, len(MEASURES)), np.float32), weight, weight
                edges = np.searchsorted(page, np.arange(stop - start + 1))
                for i, doc in enumerate(b["doc_id"].iloc[start:stop]):
                    s = slice(edges[i], edges[i + 1])
                    out.append((doc, code[s], weights[s], units[s], list(sums[s])))
            yield pd.DataFrame(out, columns=["doc_id", "shapes", "weights", "units", "sums"])

    return docs.select("doc_id", "text").mapInPandas(run, schema)


def shape_table(pages: DataFrame) -> DataFrame:
    """shape, n_units, n_pages, n_words and the means of all measures, one row a shape over all pages."""
    each = pages.select(F.explode(F.arrays_zip("shapes", "weights", "units", "sums")).alias("s")).select("s.*")
    means = [(F.sum(F.col("sums")[i]) / F.sum("units")).alias(name) for i, name in enumerate(MEASURES)]
    return each.groupBy(F.col("shapes").alias("shape")).agg(F.sum("units").alias("n_units"), F.count("*").alias("n_pages"), F.sum("weights").alias("n_words"), *means)


def verdicts(table: DataFrame) -> DataFrame:
    """table with kind: the list that a shape's units are over the corpus, empty for sentences and other text."""
    c = F.col
    # a row of many items of few words each is a list whatever its words; a shorter one if its items are alike or hold few short words
    many = (c("items") >= 8) & (c("item_words") <= 4) & (c("longest") < 10)
    sentence = (c("ends") >= 0.5) & (c("short") >= 0.2)
    listed = (c("latin") > 0.5) & (many | (c("items") >= 5) & (c("longest") < 7) & ((c("alike") >= 0.5) | ((c("short") < 0.12) & ~sentence)))
    kind = (
        F.when((c("links") >= 0.1) & ~(sentence & (c("words") > 8)), "link")
        .when(c("tags") >= 0.34, "tag")
        .when(c("crumbs") >= 2, "crumb")
        .when((c("prices") >= 1 / 14) & (c("capitals") >= 0.3), "product")
        .when(listed, "list")
        .when((c("keywords") >= 0.6) & (c("short") < 0.25) & (c("latin") > 0.5), "keyword")
        .otherwise("")
    )
    return table.withColumn("kind", kind)


def judged(docs: DataFrame) -> DataFrame:
    """doc_id, share, kind, shapes of each row: the share of its words in the list shapes that hold most of them, and what these are."""
    pages = cut_lineage(page_shapes(docs))
    found = verdicts(shape_table(pages)).where("kind <> ''").select("shape", "kind").toPandas()  # no more rows than codes
    held = docs.sparkSession.sparkContext.broadcast(dict(zip(found["shape"], found["kind"])))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        kinds = held.value
        for b in batches:
            out = []
            for doc, shapes, weights in zip(b["doc_id"], b["shapes"], b["weights"]):
                hits = sorted(((int(w), int(s)) for s, w in zip(shapes, weights) if s in kinds), reverse=True)[:FEW]
                if not hits:
                    out.append((doc, 0.0, "", ""))
                    continue
                by_kind: dict[str, int] = {}
                for w, s in hits:
                    by_kind[kinds[s]] = by_kind.get(kinds[s], 0) + w
                out.append((doc, sum(w for w, _ in hits) / int(weights.sum()), max(by_kind, key=lambda k: (by_kind[k], k)), "; ".join(spelled(s) for _, s in hits[:3])))
            yield pd.DataFrame(out, columns=["doc_id", "share", "kind", "shapes"])

    return pages.select("doc_id", "shapes", "weights").mapInPandas(run, "doc_id long, share double, kind string, shapes string")


def flagged(docs: DataFrame, share: float = SHARE) -> DataFrame:
    """Pages whose words lie mostly in few list shapes."""
    return judged(docs).where(F.col("share") > share)


def p9_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id of the flagged pages."""
    return flagged(read_table(spark, sf_dir, "documents")).select("doc_id").distinct()


def p9_shapes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages flagged, by dominating kind and shapes."""
    return flagged(read_table(spark, sf_dir, "documents")).groupBy("kind", "shapes").agg(F.count("*").alias("n_pages"), F.round(F.avg("share"), 4).alias("mean_share"))
