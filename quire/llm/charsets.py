"""Problem 2: text decoded with another code page than it was written in.

A smoothed character trigram model is trained on the clean words of all blocks, each word counted once a book
(so one garbled or hot book cannot teach it), in hashed tables of fixed size. Words that a multi-byte chain
restores, or whose restored form stands in more books than they do, are left out of the training.
Every suspicious word is then decoded again along each chain "encode as W, decode as T", repeatedly where it was
garbled twice, with lost bytes filled in by the likeliest way through the model; the likeliest form is accepted when
it beats the word as it stands by a margin. The margin is validated on every book: the books are hashed into HELD parts, each in turn is kept out of a
trial model, and all clean words of its books are judged by that model, rare ones apart, which may be garbled
themselves, each counted once a book; at most one of them, or two in a thousand, may be changed. The share of them that is recovered after
synthetic garbling is kept with the model, which has learnt all books.

Defined results: null, empty and ASCII texts are clean; replacement characters and control characters of the
C1 range are always wrongly decoded, restored where the model can tell, else marked so; repeated rows give one.
"""

from __future__ import annotations

import html
import re
import uuid
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache
from math import log
from typing import ClassVar

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.plans.session import cut_lineage, read_table

#: Slots of the hashed tables; smallest margin in nats; parts of the books that are held out in turn; repetitions of a chain; letters of a piece of an endless word.
SLOTS, MARGIN, HELD, DEPTH, PIECE = 1 << 20, 4.0, 5, 3, 100
#: Share of the books of the most frequent word from which a word is too frequent to be garbled itself.
FREQUENT = 0.05
#: Code pages a text may have been read with, and written in.
READ_AS = ("cp1252", "latin-1", "cp1250", "cp1251", "mac_roman", "cp437", "cp850", "iso8859-2", "cp1254", "cp1257", "koi8-r", "cp866", "cp852")
WRITTEN_IN = ("cp1252", "cp1250", "cp1251", "mac_roman", "cp437", "cp850", "iso8859-2", "koi8-r", "cp866", "cp1253", "cp852")
#: Pages whose texts lose bytes: their lead characters are no letters that open ordinary words.
LOSING = {"cp1252", "latin-1", "cp1250", "cp1254", "cp1257"}
#: Pages on which clean words look like sequences, with what the first two bytes of typographic marks become there.
LETTERED = {page: b"\xe2\x80".decode(page) for page in ("koi8-r", "cp866", "cp852")}
#: Chains that happen often; the others cost RARE_CHAIN nats, a mark that takes a letter's place costs MARK_FOR_LETTER.
USUAL, RARE_CHAIN, MARK_FOR_LETTER = {"cp1252>cp1250", "cp1252>cp1251", "cp437>cp1252", "latin-1>cp1251", "latin-1>cp1250", "cp1250>cp1252", "cp1251>cp1252", "mac_roman>cp1252", "cp850>cp1252", "latin-1>cp1252"}, 3.0, 8.0
#: Fixed value: typographic marks that stand correctly at the ends of words.
EDGE = "“”‘’„‚«»‹›…—–"
_PUNCT = {ord(c): "." for c in EDGE + "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"} | {ord(c): "0" for c in "0123456789"}
_ENTITY = re.compile(r"&#(?:1[2-9]\d|2[0-5]\d|x[89a-f][0-9a-f]);", re.I)
_C1 = re.compile(r"[\x80-\x84\x86-\x9f]")


@lru_cache(maxsize=1)
def _bytes_of() -> dict[str, dict[str, int]]:
    """Page -> character -> byte; bytes without a character are read as the control character of their number."""
    table = {}
    for page in READ_AS:
        chars = {}
        for b in range(128, 256):
            try:
                chars[bytes([b]).decode(page)] = b
            except UnicodeDecodeError:
                chars[chr(b)] = b
        for b in range(128, 160):
            chars.setdefault(chr(b), b)
        table[page] = chars
    return table


@lru_cache(maxsize=1)
def _leads() -> dict[str, frozenset[str]]:
    """Page -> characters that the first byte of a multi-byte sequence may have become."""
    return {p: frozenset(c for c, b in t.items() if 0xC2 <= b <= 0xF4) for p, t in _bytes_of().items()}


@lru_cache(maxsize=1)
def _lead_signs() -> dict[str, re.Pattern]:
    """Page -> pattern of its lead characters."""
    return {p: re.compile("[" + re.escape("".join(sorted(c))) + "]") for p, c in _leads().items()}


@lru_cache(maxsize=1)
def _lost() -> dict[str, list[int]]:
    """Page -> bytes it has no visible character for; they may have been dropped, and a hard space may have become a blank."""
    return {p: sorted({b for c, b in t.items() if "\x7f" < c < "\xa1" or c == "\xad"}) for p, t in _bytes_of().items()}


@lru_cache(maxsize=1)
def _swaps() -> list[tuple[str, dict[int, str]]]:
    """Single-byte chains as translation tables; pages that agree on the characters at hand give one chain."""
    out = []
    for w, chars in _bytes_of().items():
        for t in WRITTEN_IN:
            if w == t:
                continue
            table = {}
            for c, b in chars.items():
                try:
                    table[ord(c)] = bytes([b]).decode(t)
                except UnicodeDecodeError:
                    pass
            out.append((f"{w}>{t}", table))
    return out


@lru_cache(maxsize=1)
def _able() -> dict[int, int]:
    """Character -> the single-byte chains that can read it, a bit each."""
    out: dict[int, int] = {}
    for i, (_, table) in enumerate(_swaps()):
        for c in table:
            out[c] = out.get(c, 0) | 1 << i
    return out


def _wide(word: str, page: str, lossy: bool, model: CharModel | None = None) -> list[str]:
    """Forms of a word whose multi-byte sequences of UTF-8 were read as single characters of a page; lossy: with lost bytes filled in.

    With a model, of the forms that agree in their last two characters only the likeliest goes on, and a filling that it
    never saw gives way to one it did, which loses none that could win; without it only the first of each goes on,
    enough to tell whether there are any.
    """
    step = model.step if model else None
    chars, i, n, changed = _bytes_of()[page], 0, len(word), False
    ends: dict[str, tuple[float, str, str]] = {"\x02\x02": (0.0, "", "\x02\x02")}  # last two characters -> score and text of the likeliest form with them, and what the model sees of them
    leads = _lead_signs()[page]
    while i < n:
        if len(ends) == 1 and (literal := word[i : m.start() if (m := leads.search(word, i)) else n]):
            ((end, (score, form, seen)),) = ends.items()
            ends = {(end + literal)[-2:]: (score, form + literal, (seen + literal.translate(_PUNCT))[-2:])}
            i += len(literal)
            continue
        b = chars.get(word[i], 0)
        k = 2 if 0xC2 <= b <= 0xDF else 3 if 0xE0 <= b <= 0xEF else 4 if 0xF0 <= b <= 0xF4 else 0
        got, used = _options(page, lossy, b, tuple(chars.get(c, 0) for c in word[i + 1 : i + k])) if k else ((), 1)
        if got:
            changed = True
            i += used
        else:
            got = (word[i],)
            i += 1
        if len(ends) == len(got) == 1:  # one way so far and on
            ((end, (score, form, seen)),) = ends.items()
            ends = {(end + got[0])[-2:]: (score, form + got[0], (seen + got[0].translate(_PUNCT))[-2:])}
            continue
        if model and len(got) > 1:
            got = tuple(filter(model.saw, got)) or got
        shown = [(g, g.translate(_PUNCT)) for g in got]
        now: dict[str, tuple[float, str, str]] = {}
        for end, (score, form, seen) in ends.items():
            for g, as_seen in shown:
                last, more = (end + g)[-2:], score
                if step:
                    three = seen + as_seen
                    more += step(three) if len(three) == 3 else sum(step(three[j - 2 : j + 1]) for j in range(2, len(three)))
                if last not in now or more > now[last][0]:
                    now[last] = (more, form + g, (seen + as_seen)[-2:])
        ends = now
    return [form for _, form, _ in ends.values()] if changed else []


@lru_cache(maxsize=1 << 16)
def _options(page: str, lossy: bool, b: int, tail: tuple[int, ...]) -> tuple[tuple[str, ...], int]:
    """(what a sequence may have been that opens with byte b before the bytes tail, characters it takes); nothing when it is none."""
    k = 2 if b <= 0xDF else 3 if b <= 0xEF else 4
    m = next((j for j, x in enumerate(tail) if not 0x80 <= x <= 0xBF), len(tail))
    seqs, used = [], 1
    if m == k - 1:
        seqs, used = [bytes([b, *tail])], k
    elif lossy and m == k - 2:  # one byte is gone: the last, or the one before it
        lost = (*_lost()[page], 0xA0)
        seqs, used = [bytes([b, *tail[:m], x]) for x in lost] + [bytes([b, x, tail[0]]) for x in lost if m], m + 1
    elif lossy and k == 3 and page == "latin-1":  # both bytes of a typographic mark
        seqs = [bytes([b, 0x80, x]) for x in (0x93, 0x94, 0x98, 0x99, 0x9C, 0x9D, 0xA6)]
    got = []
    for s in seqs:
        try:
            got.append(s.decode("utf-8"))
        except UnicodeDecodeError:
            pass
    return tuple(dict.fromkeys(got)), used


def candidates(word: str, stage: int, model: CharModel | None = None, single: bool = True) -> Iterator[tuple[str, str]]:
    """(chain, form) of a word. Stage 0: whole multi-byte sequences; 1: such with lost bytes, and, if single, swapped bytes and single-byte pages."""
    plain = html.unescape(word) if "&#" in word else word
    if plain != word and not plain.isascii():
        yield "entity", plain
    for page in READ_AS:
        # on some pages the bytes of whole letters read as letters too: only signs among them, or the start of a typographic mark, tell
        if _leads()[page].isdisjoint(plain) or page in LETTERED and plain.strip(EDGE).isalpha() and LETTERED[page] not in plain:
            continue
        for form in _wide(plain, page, stage > 0 and page in LOSING, model):
            yield f"{page}>utf-8", form
    if not stage or not single:
        return
    if sum(0x20 <= ord(c) >> 8 < 0x7F and not ord(c) & 0xFF for c in plain) * 2 >= len(plain) or all(0x600 <= ord(c) for c in plain):
        try:
            yield "utf-16-be>utf-16-le", plain.encode("utf-16-le").decode("utf-16-be")
        except UnicodeError:
            pass
    core = plain.strip(EDGE)
    marked = [ord(c) for c in set(core) if c > "\x7f"]
    if not marked:
        return
    swaps, able = _swaps(), _able()
    chains = -1
    for c in marked:
        chains &= able.get(c, 0)
    seen = {tuple(map(chr, marked))}
    while chains:  # the pages that have all of the characters, each reading of them once
        low = chains & -chains
        chains ^= low
        chain, table = swaps[low.bit_length() - 1]
        reading = tuple(map(table.__getitem__, marked))
        if reading not in seen:
            seen.add(reading)
            yield chain, plain.replace(core, core.translate(table))




def _slot(a: int, b: int, d: int) -> tuple[int, int, int, int]:
    """Hashed slots of a trigram, its context, its bigram, its character."""
    ctx = (a * 2654435761 + b * 40503) & 0xFFFFFFFF
    return (ctx * 31 + d * 2246822519) % SLOTS, (ctx * 17 + 7) % SLOTS, (b * 3266489917 + d * 668265263 + 3) % SLOTS, (d * 374761393 + 5) % SLOTS


def _slots(word: str) -> Iterator[tuple[int, int, int, int]]:
    """The slots of each position of a word and its end."""
    c = [ord(x) for x in "\x02\x02" + word.translate(_PUNCT) + "\x03"]
    return (_slot(c[i - 2], c[i - 1], c[i]) for i in range(2, len(c)))


class CharModel:
    """Interpolated character trigrams in hashed tables."""

    def __init__(self, tri: np.ndarray, ctx: np.ndarray, bi: np.ndarray, uni: np.ndarray):
        self.tables = (tri, ctx, bi, uni)
        self.total = float(uni.sum()) or 1.0
        self.margin, self.recovered = MARGIN, 0.0
        self._views()

    def _views(self) -> None:
        # reading a memory view is faster than reading an array one number at a time
        self.known: dict[str, float] = {}
        self.sights: dict[str, bool] = {}
        self.seen: dict[tuple[str, bool, float], tuple[float, str, str] | None] = {}
        self.tri, self.ctx, self.bi, self.uni = (memoryview(np.ascontiguousarray(t)) for t in self.tables)

    def __getstate__(self) -> dict:
        return {"tables": self.tables, "total": self.total, "margin": self.margin, "recovered": self.recovered}

    def __setstate__(self, state: dict) -> None:
        self.__dict__.update(state)
        self._views()

    def knows(self, word: str) -> bool:
        """Whether every non-ASCII character of a word occurs in clean words."""
        return all(c < "\x80" or c in EDGE or self.uni[(ord(c) * 374761393 + 5) % SLOTS] > 0 for c in word)

    def saw(self, c: str) -> bool:
        """Whether a character occurs in clean words."""
        if c not in self.sights:
            self.sights[c] = self.knows(c)
        return self.sights[c]

    def steps(self, word: str) -> list[float]:
        """Log probability of each character, and of the end."""
        known = self.known
        if len(known) > 400_000:
            known.clear()
        s = "\x02\x02" + word.translate(_PUNCT) + "\x03"
        out = []
        for i in range(2, len(s)):
            k = s[i - 2 : i + 1]
            p = known.get(k)
            if p is None:
                p = known[k] = self._step(k)
            out.append(p)
        return out

    def step(self, three: str) -> float:
        """Log probability of the third character behind the others."""
        p = self.known.get(three)
        if p is None:
            p = self.known[three] = self._step(three)
        return p

    def _step(self, three: str) -> float:
        t, x, b, u = _slot(*map(ord, three))
        p3 = self.tri[t] / (self.ctx[x] + 1.0)
        p2 = self.bi[b] / (max(self.ctx[x], self.uni[(ord(three[1]) * 374761393 + 5) % SLOTS]) + 4.0)
        return log(0.75 * p3 + 0.2 * p2 + 0.05 * self.uni[u] / self.total + 1e-8)

    def room(self, word: str) -> float:
        """What any chain could gain at most. Chains change no ASCII character, so steps among these stay; the others cannot rise above 0.

        Endless where characters may be halves of others: swapped bytes change ASCII too.
        """
        if any(c >= "\u2000" and c not in EDGE for c in word) or all(c >= "\u0600" for c in word):
            return float("inf")
        marked = [c > "\x7f" for c in word]
        touched = [False] * (len(word) + 1)
        for i, m in enumerate(marked):
            if m:
                touched[i : i + 3] = [True] * len(touched[i : i + 3])
        return -sum(p for p, t in zip(self.steps(word), touched) if t)

    def score(self, word: str) -> float:
        return sum(self.steps(word))

    @staticmethod
    def cost(word: str, chain: str, form: str) -> float:
        if chain.endswith("utf-8") or chain == "entity" or "utf-16" in chain:
            return 0.0
        marks = len(form) == len(word) and any(f in EDGE and w.isalpha() and 0 < i and word[i - 1].isalpha() for i, (w, f) in enumerate(zip(word, form)))
        return (0.0 if chain in USUAL else RARE_CHAIN) + (MARK_FOR_LETTER if marks else 0.0)

    def best(self, word: str) -> tuple[float, str, str]:
        """(gain, chain, form) of the likeliest chain; gain 0 and the word itself where none is likelier."""
        start = now = self.score(word)
        form, chain = word, ""
        for _ in range(DEPTH):
            if chain and chain != "entity" and form.strip(EDGE).isascii():
                break
            key = (form, chain not in ("", "entity"), round(now, 6))
            if key not in self.seen:
                if len(self.seen) > 100_000:
                    self.seen.clear()
                self.seen[key] = self._next(*key)
            found = self.seen[key]
            if not found or found[0] <= now + 1.0:
                break
            now, form, chain = found[0], found[2], f"{chain}|{found[1]}" if chain else found[1]
        return now - start, chain, form

    def _next(self, form: str, later: bool, now: float) -> tuple[float, str, str] | None:
        """(score, chain, form) of the likeliest decoding of a form; many garbled words lead to one form, so it is remembered."""
        # whole sequences first, through all their repetitions
        tried, level = {}, [(form, "")]
        for _ in range(DEPTH):
            level = [(f, f"{done}|{c}" if done else c) for w, done in level for c, f in dict.fromkeys(candidates(w, 0, self)) if f != w and f not in tried and c != "entity" or "&#" in w]
            for f, c in level:
                tried.setdefault(f, c)
        known = {f: c for f, c in tried.items() if self.knows(f)}
        found = max(((self.score(f), c, f) for f, c in known.items()), default=None, key=lambda x: x[0])
        if found and found[0] > now + self.margin:
            return found
        tried = {}
        for c, f in candidates(form, 1, self, not later):
            # a step between single-byte pages never follows another chain, and wide sequences may need one more step
            if f != form and f not in tried and "\ufffd" not in f and (c.endswith("utf-8") or not later) and (c.endswith("utf-8") and not later or self.knows(f)):
                tried[f] = c
        return max(((self.score(f) - self.cost(form, c, f), c, f) for f, c in tried.items()), default=None, key=lambda x: x[0])

    def fill(self, word: str) -> str:
        """Replacement characters filled by the likeliest letters, one after the other."""
        while "�" in word:
            i = word.index("�")
            inside = 0 < i and word[i - 1].isalpha()
            # marks are one class to the model, so inside a word they must be far likelier than a letter
            word = max((word[:i] + c + word[i + 1 :] for c in _LETTERS), key=lambda w: self.score(w.replace("�", "")) - (4.0 if inside and w[i] in EDGE else 0.0))
        return word

    def trial(self, word: str, k: int) -> tuple[float, float | None]:
        """(gain of a clean word, gain of its k-th garbling), below 0 where that does not lead back to it, None where it can't be garbled so."""
        try:
            bad = word.encode("utf-8").decode(("cp1252", "latin-1", "mac_roman", "cp437")[k % 4])
        except UnicodeError:
            return self.best(word)[0], None
        gain, _, form = self.best(bad)
        return self.best(word)[0], gain if form == word else -1.0

    def validate(self, clean: Counter, garbled: Counter) -> None:
        """Raise the margin above the gains of all clean words but the first, or two in a thousand; measure what it recovers of garbled ones.

        Both count words by their gain, once a book, the garbled ones that do not lead back below 0.
        """
        left, top = max(clean[max(clean, default=0.0)], clean.total() // 500), 0.0
        for top in sorted(clean, reverse=True):
            left -= clean[top]
            if left < 0:
                break
        self.margin = max(MARGIN, top + 0.5)
        self.recovered = sum(n for gain, n in garbled.items() if gain > self.margin) / garbled.total() if garbled else 1.0


_LETTERS = "éèêàâùûôîïëçñáíóúãõäöüßåøœæ“”’‘…—–«»ąćęłńśźżÉÀÈÁÓÚÑÄÖÜØÅ"


def suspicious(text: str) -> list[str]:
    """Words of a text that are not plainly ASCII inside their typographic marks."""
    if text.isascii() and "&#" not in text:
        return []
    return [w for w in set(text.split()) if not (w.isascii() or w.strip(EDGE).isascii()) or "&#" in w]


def word_table(blocks: DataFrame) -> DataFrame:
    """word, n, held, marked: books that hold a non-ASCII word, and those of them in each part; for ASCII words the logarithm of their occurrences, in no part."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        plain: Counter = Counter()
        for b in batches:
            marked: set = set()
            for book, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                if not text:
                    continue
                if text.isascii():
                    plain.update(text.split())
                else:
                    words = text.split()
                    plain.update(w for w in words if w.isascii())
                    for w in set(words):
                        if not w.isascii() and not (core := w.strip(EDGE)).isascii():
                            marked.add((book or "", core))
            books, words = zip(*marked) if marked else ((), ())
            yield pa.RecordBatch.from_arrays([pa.array(books, pa.string()), pa.array(words, pa.string()), pa.array([0] * len(books), pa.int64())], names=["book", "word", "n"])
        bare: Counter = Counter()
        for w, n in plain.items():
            bare[w.translate(_PUNCT)] += n
        yield pa.RecordBatch.from_arrays([pa.array([""] * len(bare), pa.string()), pa.array(list(bare), pa.string()), pa.array(list(bare.values()), pa.int64())], names=["book", "word", "n"])

    rows = blocks.select("book_id", "text").where("text is not null").mapInArrow(run, "book string, word string, n long")
    once = rows.groupBy("book", "word").agg(F.sum("n").alias("n"))
    part = F.when(F.col("book") != "", F.pmod(F.xxhash64("book"), F.lit(HELD)))
    held = F.array(*[F.count_if(part == k).cast("double") for k in range(HELD)])
    per = once.groupBy("word").agg(F.sum("n").alias("k"), F.count("*").cast("double").alias("books"), held.alias("held"))
    return per.select("word", F.when(F.col("k") > 0, F.log2(F.col("k") + 1.0)).otherwise(F.col("books")).alias("n"), "held", (F.col("k") == 0).alias("marked"))


def tables(words: DataFrame) -> np.ndarray:
    """The four tables of words that count n each; at most 4 x SLOTS rows reach the driver."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        acc = np.zeros((4, SLOTS))
        for b in batches:
            for w, n in zip(b["word"], b["n"]):
                for slots in _slots(w):
                    for k in range(4):
                        acc[k, slots[k]] += n
        k, s = np.nonzero(acc)
        yield pd.DataFrame({"k": k.astype(np.int32), "slot": s.astype(np.int32), "n": acc[k, s]})

    counted = words.mapInPandas(run, "k int, slot int, n double").groupBy("k", "slot").agg(F.sum("n").alias("n")).toPandas()
    acc = np.zeros((4, SLOTS))
    acc[counted["k"], counted["slot"]] = counted["n"]
    return acc


def gains(words: DataFrame, model: CharModel) -> tuple[Counter, Counter]:
    """How many words have which gain, in hundredths upwards, as they stand and garbled, each counted n times; one row a gain reaches the driver."""
    held = words.sparkSession.sparkContext.broadcast(model)  # fixed size

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for w, k, n in zip(b["word"], b["k"], b["n"]):
                clean, garbled = held.value.trial(w, k)
                out += [(True, clean, n)] + [(False, garbled, n)] * (garbled is not None)
            yield pd.DataFrame(out, columns=["clean", "gain", "n"]).astype({"clean": bool, "gain": float, "n": int})

    rows = words.select("word", "n", F.pmod(F.xxhash64("word"), F.lit(4)).cast("int").alias("k")).mapInPandas(run, "clean boolean, gain double, n long")
    counted = rows.groupBy("clean", F.ceil(F.col("gain") * 100).alias("gain")).agg(F.sum("n").alias("n")).collect()
    held.unpersist()
    return tuple(Counter({r["gain"] / 100: r["n"] for r in counted if r["clean"] == clean}) for clean in (True, False))


def train(blocks: DataFrame) -> CharModel:
    """The model of the blocks' clean words. Of the corpus only tables of SLOTS numbers and counts of gains reach the driver."""
    words = cut_lineage(word_table(blocks))

    def forms(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for w, n in zip(b["word"], b["n"]):
                if "�" in w or _C1.search(w) or "&#" in w:
                    out.append((w, w, True))
                    continue
                wide = False
                for chain, f in candidates(w, 0):
                    if chain.endswith(">utf-8") and len(f) < len(w) and not any("\x7f" < c < "\xa1" for c in f):
                        wide = True
                        break
                if not wide:
                    others = dict.fromkeys((f, c) for c, f in candidates(w, 1))
                    # half of a typographic mark behind or before a plain word
                    # and swapped bytes that read as letters of an alphabet the other way round
                    wide = any(c.endswith(">utf-8") and len(f) < len(w) and f.strip(EDGE).isascii() or "utf-16" in c and all(x < "\u0530" or x in EDGE for x in f) for f, c in others)
                    out += [(w, f.strip(EDGE), False) for f in {f for f, _ in others}]
                if wide:
                    out.append((w, w, True))
            yield pd.DataFrame(out, columns=["word", "form", "sure"]).astype({"sure": bool})

    marked = words.where("marked").select("word", "n")
    alt = marked.mapInPandas(forms, "word string, form string, sure boolean")
    known = marked.select(F.col("word").alias("form"), F.col("n").alias("of"))
    worse = alt.where("not sure").join(known, "form").join(marked, "word").where("of > 3 * n").select("word").unionByName(alt.where("sure").select("word")).distinct()
    clean = cut_lineage(words.where("marked").join(worse, "word", "left_anti"))
    every = tables(clean.select("word", "n").unionByName(words.where("not marked").select("word", "n")))
    model = CharModel(*every.astype(np.float32))
    most = clean.where(F.exists("held", lambda n: n > 0)).agg(F.max("n")).first()[0]
    if most:
        as_is, garbled = Counter(), Counter()
        for k in range(HELD):
            part = clean.select("word", F.col("held")[k].alias("n"), F.col("n").alias("of")).where("n > 0")
            # the logarithms of ASCII words leave rests of rounding
            trial = CharModel(*np.round(every - tables(part.select("word", "n")), 6).astype(np.float32))
            for total, found in zip((as_is, garbled), gains(part.where(F.col("of") >= FREQUENT * most), trial)):
                total.update(found)
        model.validate(as_is, garbled)
    return model


def pieces_of(word: str) -> list[str]:
    """An endless word in pieces of PIECE to twice as many letters, cut ahead of a character that continues no sequence where there is one."""
    out, at = [], 0
    while len(word) - at > 2 * PIECE:
        end = next((i for i in range(at + PIECE, at + 2 * PIECE) if word[i] < "\x80" or any(word[i] in leads for leads in _leads().values())), at + PIECE)
        out.append(word[at:end])
        at = end
    return [*out, word[at:]]


class Judge:
    """Verdicts on words, remembered up to a bound."""

    def __init__(self, model: CharModel, most: int = 200_000):
        self.model, self.most, self.known = model, most, {}

    _runs: ClassVar[dict[str, Judge]] = {}

    @classmethod
    def of_run(cls, run_id: str, model: CharModel) -> Judge:
        """The judge of the run at hand: a worker keeps what it has judged from task to task."""
        if run_id not in cls._runs:
            cls._runs.clear()
            cls._runs[run_id] = cls(model)
        return cls._runs[run_id]

    def word(self, w: str) -> tuple[bool, str, str]:
        """(garbled, restored form, chain)."""
        if w not in self.known:
            if len(self.known) > self.most:
                self.known.clear()
            self.known[w] = self._word(w)
        return self.known[w]

    def _word(self, w: str) -> tuple[bool, str, str]:
        m = self.model
        bad = "�" in w
        if not bad and "&#" not in w and not _C1.search(w) and m.room(w) <= m.margin:
            return False, w, ""  # no chain can be likelier by the margin
        if len(w) > 2 * PIECE:
            w_long, parts = w, pieces_of(w)
            got = [self.word(p) for p in parts]
            return any(g[0] for g in got), "".join(g[1] for g in got) if any(g[0] for g in got) else w_long, next((g[2] for g in got if g[0]), "")
        gain, chain, form = m.best(w)
        # a form with characters that no clean word has must be far likelier
        if gain > (m.margin if m.knows(form) else m.margin + 20) and chain != "entity":
            return True, m.fill(form), chain
        if bad:
            return True, m.fill(w), "replacement"
        if _C1.search(w):
            return True, form if gain > 0 else w, chain or "control"
        return False, w, ""

    def text(self, text: str | None, restore: bool = True) -> tuple[str, str] | None:
        """(restored text, chains) of a garbled text, None for a clean one; without restore the first garbled word is enough."""
        if not text:
            return None
        words = {}
        for w in suspicious(text):
            hit, form, chain = self.word(w)
            if hit:
                words[w] = (form, chain)
                if not restore:
                    return text, chain
        if not words:
            return None
        swapped = any("utf-16" in c for _, c in words.values())
        parts = re.split(r"(\s+)", text)
        out = "".join(words[p][0] if p in words else p.replace(" ", " ") if swapped else p for p in parts)
        return out, " ".join(sorted({c for _, c in words.values()}))


def garbled(blocks: DataFrame, text: str = "text", model: CharModel | None = None, restore: bool = True) -> DataFrame:
    """The columns of blocks for the affected rows, with restored, chains and restorable; restored is null without restore."""
    spark = blocks.sparkSession
    model = model or train(blocks.select("book_id", F.col(text).alias("text")))
    held, run_id = spark.sparkContext.broadcast(model), uuid.uuid4().hex  # fixed size
    keys = [c for c in blocks.columns if c not in (text, "restored", "chains", "restorable")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        judge = Judge.of_run(run_id, held.value)
        for b in batches:
            got = [judge.text(t, restore) for t in b.column(len(keys)).to_pylist()]
            take = pa.array([i for i, g in enumerate(got) if g], pa.int64())
            rows = b.take(take)
            hits = [g for g in got if g]
            arrays = [rows.column(i) for i in range(len(keys) + 1)] + [
                pa.array([h[0] if restore else None for h in hits], pa.string()), pa.array([h[1] for h in hits], pa.string()),
                pa.array([not any(x in h[1].split() for x in ("replacement", "control")) for h in hits], pa.bool_()),
            ]
            yield pa.RecordBatch.from_arrays(arrays, names=[*keys, text, "restored", "chains", "restorable"])

    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in blocks.select(*keys, text).schema), "restored string, chains string, restorable boolean"])
    # rows of plain ASCII never reach Python
    odd = blocks.select(*keys, text).where(F.col(text).rlike(r"[^\x00-\x7F]|&#"))
    return odd.mapInArrow(run, schema)


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """book_id, block_ord of the affected blocks, once each."""
    return garbled(read_table(spark, sf_dir, "blocks").select("book_id", "block_ord", "text"), restore=False).select("book_id", "block_ord").distinct()


def p2_restored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The affected blocks with their text, the restored text, the chains and the declared code page of the book."""
    found = garbled(read_table(spark, sf_dir, "blocks").select("book_id", "block_ord", "text")).dropDuplicates(["book_id", "block_ord"])
    declared = read_table(spark, sf_dir, "mobi_headers").groupBy("book_id").agg(F.max("text_encoding").alias("declared"))
    return found.join(declared, "book_id", "left")
