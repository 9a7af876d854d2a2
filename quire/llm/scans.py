"""Problem 4: noise of scanned pages, by decoding the de-lined character stream of each record over a lattice of words.

Word counts over all blocks and paragraphs give the language model. A record's lines are freed of running heads and
page numbers and become one stream. Over the stream lies a lattice: its nodes are places in the stream, its edges read a
stretch of characters as a word, or as nothing. An edge keeps a word, undoes one or two confusions of the recogniser,
splits words that run together, merges a word that blanks fell into, joins or keeps a hyphen at a line's end, or
drops a stray sign, a page number or a running head. A word's price is its rarity; one that nothing else in the
corpus vouches for is priced by its letters. The cheapest path is the repaired text. Where no edge but that of keeping exists,
the only path is the text itself and nothing is searched.

Paragraph boundaries are chosen by dynamic programming over each run of neighbours whose ends lie open: a break or a
join at every boundary, by the marks, words and letters on both sides and the length of what is joined. Neighbours
are found by windows over ranges of order numbers, so no window holds a whole book. Every part stands in exactly one paragraph.

Defined results: null and blank texts are no damage and do not separate neighbours; headings and scene breaks are
never damaged and end a paragraph; repeated rows give one record; a record without order number is judged alone.
Capitalised words are not split, since invented names are often made of words, nor are words with other than ASCII
letters, where wrong decoding looks like letters.
"""

from __future__ import annotations

import re
import uuid
from collections import Counter
from collections.abc import Iterator
from math import log
from typing import ClassVar

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quire.plans.session import cut_lineage, most_frequent, read_table, small_broadcast

#: Words of the language model that are broadcast (the rest is joined to the records that ask for them), books whose titles may be broadcast, order numbers of a range of neighbours.
LEXICON, TITLES, RANGE = 300_000, 200_000, 512
#: A misread word is this much rarer than what it stands for; rare at all is below this share of all words.
RATIO, SURE, RARE = 8.0, 100.0, 4e-6
#: What recognition made of letters -> the letters.
CONFUSIONS = [
    ("c", "e"), ("ø", "a"), ("ø", "o"), ("0", "o"), ("f", "t"), ("cl", "d"), ("1", "l"), ("1", "i"), ("5", "s"), ("!", "i"), ("!", "l"), ("|", "l"), ("|", "i"), ("rn", "m"), ("vv", "w"),
    ("b", "h"), ("li", "h"), ("ii", "u"), ("q", "g"), ("m", "in"), ("m", "rn"), ("m", "ni"), ("y", "v"), ("h", "li"), ("n", "ri"), ("d", "cl"), ("8", "b"), ("6", "b"), ("9", "g"), ("@", "a"), ("€", "e"), ("$", "s"),
    ("ﬀ", "ff"), ("ﬁ", "fi"), ("ﬂ", "fl"), ("ﬃ", "ffi"), ("ﬄ", "ffl"), ("nn", "m"), ("tl", "th"),
]
_ROMAN = r"(?=[ivxlcdm]{2,}\b)m{0,3}(?:cm|cd|d?c{0,3})(?:xc|xl|l?x{0,3})(?:ix|iv|v?i{0,3})"
_NUMBER = rf"(?:\d{{1,4}}|{_ROMAN})"
#: A line that is only a page number.
_FOLIO = re.compile(rf"(?:[-–—\[(]\s*)?(?:p(?:age|g)?\.?\s*)?{_NUMBER}(?:\s*(?:/|of)\s*\d{{1,4}})?(?:\s*[-–—\])])?", re.I)
#: A running head with its page number before or after it.
_HEAD = re.compile(rf"(?:{_NUMBER}\s*(?:[|·•]|\s{{2,}}|\s)\s*(?P<a>[^\W\d_].*)|(?P<b>.*[^\W\d_.][.\w]*)\s*(?:[|·•]|\s{{2,}}|\s)\s*{_NUMBER})", re.S)
_NUMBERED = re.compile(r"\d|^\W*[ivxlcdm]{2,}\W*$", re.I)
_CAPS = re.compile(r"(?:\d{1,4}\s+)?\b[A-ZÀ-ÞŁŚŻ]{2,}(?![^\W\d_])(?:[-'’\s]+(?:[A-ZÀ-ÞŁŚŻ]+(?![^\W\d_])|[a-z]{1,3}(?=\s+[A-Z])))*(?:\s+\d{1,4})?")
_INLINE = re.compile(r"\[\d{1,4}\]|[—–-] \d{1,4} [—–-](?= )|\bp\. \d{1,4} / \d{1,4}|\bPage \d{1,4}\b(?: of \d+)?|[|·] \d{1,4}(?= )")
_STRAY = re.compile(r"(?<=[\w,;.!?”\"’»…]) (?:[|¦•·~^°*_\\<>=]|'\.) (?=[\w\"“«‘—–])|^[|¦•·~^°] (?=\w)|(?<=[\w.]) [|¦•·~^°]$")
_PAGE = re.compile(rf"(?<=[a-zà-ÿ,;]) ({_ROMAN}|[vx]) (?=[a-zà-ÿ])")
#: What the searches for signs need to find something: a sign or digit, two capitals, a hyphen before a blank.
_FIGURE, _CAPITALS, _SIGN = re.compile(r"\d"), re.compile(r"[A-ZÀ-ÞŁŚŻ]{2}"), re.compile(r"[|¦•·~^°*_\\<>=]|'\.")
_MARKED = re.compile(r"[\d|¦•·~^°*_\\<>=¬\xad]|[A-ZÀ-ÞŁŚŻ]{2}|- |'\. ")
_DIGIT = re.compile(r"(?<=[a-zà-ÿ,;\-¬\xad]) (?:\d{1,3}) (?=[a-zà-ÿ])")
_UPPER, _LETTER = re.compile(r"[A-ZÀ-ÞŁŚŻ]"), re.compile(r"[^\W\d_]")
_SMALL = {"a", "an", "and", "the", "of", "for", "in", "on", "to", "at", "by", "from", "with", "or", "de", "la", "le", "der", "die", "das", "und", "von"}
_CORE = re.compile(r"^[\"“”‘’«»'(\[—–]*(.*?)[\"“”’«»'.,;:!?…)\]—–]*$", re.S)
_BREAK = re.compile(r"([^\W\d_]+)([-¬\xad])\s+([^\W\d_]+)")
_ENDED = re.compile(r"[.!?…:][\"'”’»)\]]*$")
_SHUT = frozenset([""]) | frozenset(".!?…:\"”’»)]")
#: A text's last word, and the mark that leaves it open.
_OPEN = re.compile(r"(?:^|[\s\"“«(\[—–])(?:[^\W\d_]+[-'’])*([^\W\d_]+)([,;]|[-¬\xad])?$")
#: Costs in nats: a confusion, a merge, a split, a split at a word as frequent as one in a thousand, a drop; a word nothing vouches for and each of its letters.
CONFUSED, MERGED, SPLIT, SPLIT_SMALL, DROPPED, UNKNOWN, LETTER = 1.5, 3.0, 9.0, 4.0, 2.0, 5.0, 2.0
#: Times a word counts by standing in a block and in the paragraph made of it.
OWN = 2
#: Costs of a break behind a word, behind a comma, a hyphen, and a word of a thousandth of all; of a join ahead of a capital or sign; characters from which a paragraph is long.
BREAKS, CAPITAL, LONG = {"word": 3.0, "mark": 3.0, "small": 5.0, "hyphen": 6.0}, 4.0, 5_000


def core_of(word: str) -> str:
    """The word without the marks around it."""
    return _CORE.match(word).group(1)


def titled(line: str) -> bool:
    """Whether a line is written like a title: all capitals, or capitals but for small words; two to ten words."""
    words = re.findall(r"[^\W\d_]+(?:[-'’][^\W\d_]+)*", line)
    if not 1 <= len(words) <= 11 or re.search(r"[!?;:\"“”«»…]|[.,]$|^\W*[—–]", line.strip()):
        return False
    return all(w[0].isupper() or w.lower() in _SMALL for w in words) and words[0][0].isupper()


def is_shouted(text: str) -> bool:
    """Whether most letters are capitals; such a text says nothing by them."""
    return 2 * len(_UPPER.findall(text)) > len(_LETTER.findall(text))


def bare_title(line: str) -> bool:
    """A title without number, comma or full stop: two capitalised words at least, the last word one of them."""
    words = line.split()
    return len(words) > 1 and not re.search(r"[.,\d]", line) and titled(line) and words[-1][0].isupper() and sum(w[0].isupper() for w in words) > 1


def _roman(n: int) -> str:
    out = ""
    for value, sign in ((100, "c"), (90, "xc"), (50, "l"), (40, "xl"), (10, "x"), (9, "ix"), (5, "v"), (4, "iv"), (1, "i")):
        while n >= value:
            out += sign
            n -= value
    return out


ROMAN = frozenset(_roman(n) for n in range(2, 1000))


class _Readings(dict):
    """Word as it stands in a text -> (its repaired forms with their costs, whether it is rare), None when nothing is to be tried; remembered up to a bound."""

    def __init__(self, reader: Reader):
        super().__init__()
        self.reader = reader

    def __missing__(self, w: str) -> tuple[tuple[tuple[str, float, str], ...], bool] | None:
        r = self.reader
        core = core_of(w)
        got = None
        if core and not core.isdigit() and not (w.isalpha() and r.counts.get(w, 0) > r.rare * 40):
            options = []
            if fixed := r.misread(core):
                options.append((w.replace(core, fixed, 1), r.price(fixed) + CONFUSED, "misread"))
            elif cut := r.split(core):
                options.append((w.replace(core, cut[0], 1), cut[1], "split"))
            rare = core.islower() and core.isalpha() and r.counts.get(core, 0) <= r.rare
            got = (tuple(options), rare) if options or rare else None
        if len(self) > 300_000:
            self.clear()
        self[w] = got
        return got


class _Counts:
    """Counts with those that a record has of its own; notes the words that are in neither."""

    def __init__(self, base: dict[str, int]):
        self.base, self.own, self.missed = base, {}, set()

    def get(self, word: str, default: int = 0) -> int:
        n = self.base.get(word)
        if n is None and (n := self.own.get(word)) is None:
            self.missed.add(word)
            return default
        return n

    def turn(self, reader: Reader, words: list[str] | None, ns: list[int] | None) -> None:
        """Start a record."""
        self.own, self.missed = dict(zip(words, map(int, ns))) if words is not None else {}, set()
        reader.known.clear()
        reader.fixed.clear()
        reader.cuts.clear()


class Reader:
    """Judges and repairs records with word counts."""

    def __init__(self, counts: dict[str, int], total: int):
        self.counts, self.total = counts, max(total, 1)
        self.known: dict[str, str | None] = {}
        self.fixed = _Readings(self)
        self.cuts: dict[str, tuple[str, float] | None] = {}
        self.rare = max(3.0, RARE * self.total)
        self.floor = log(self.total + 1)

    _runs: ClassVar[dict[str, Reader]] = {}

    @classmethod
    def of_run(cls, run_id: str, counts: dict[str, int], total: int, more_words: bool) -> Reader:
        """The reader of the run at hand: a worker keeps what it has resolved from task to task."""
        if run_id not in cls._runs:
            cls._runs.clear()
            cls._runs[run_id] = cls(_Counts(counts) if more_words else counts, total)
        return cls._runs[run_id]

    # words

    def price(self, core: str) -> float:
        """Nats of a word; one that stands here only is priced by its letters."""
        low = core.lower()
        n = self.counts.get(low, 0)
        return self.floor - log(n + 0.3) if n > OWN else max(self.floor, UNKNOWN + LETTER * len(low))

    def split(self, core: str) -> tuple[str, float] | None:
        """(words, cost) of words that run together: the cheapest segmentation of the letters, if cheaper than the word itself."""
        if len(core) < 4 or not core.isascii() or not core.isalpha() or not core.islower() or self.counts.get(core, 0) > OWN or len(core) > 60:
            return None
        if core not in self.cuts:
            small = self.total / 1000
            # best[j]: cheapest reading of the first j letters as words of two letters at least
            best: list[tuple[float, int]] = [(0.0, 0)] + [(1e18, 0)] * len(core)
            for j in range(2, len(core) + 1):
                for i in range(max(0, j - 24), j - 1):
                    n = self.counts.get(core[i:j], 0)
                    if n > self.rare and best[i][0] < 1e18:
                        cost = best[i][0] + self.floor - log(n + 0.3) + (0.0 if i == 0 else SPLIT_SMALL if n > small or self.counts.get(core[:i], 0) > small else SPLIT)
                        if cost < best[j][0]:
                            best[j] = (cost, i)
            cost, j, words = best[-1][0], len(core), []
            while j > 0 and cost < 1e18:
                words.append(core[best[j][1] : j])
                j = best[j][1]
            if len(self.cuts) > 100_000:
                self.cuts.clear()
            self.cuts[core] = (" ".join(reversed(words)), cost) if cost < self.price(core) else None
        return self.cuts[core]

    def _near(self, w: str) -> list[str]:
        """Words that differ by one confusion."""
        out = []
        for bad, good in CONFUSIONS:
            if bad in w:
                i, k = w.find(bad), len(bad)
                while i >= 0:
                    out.append(w[:i] + good + w[i + k :])
                    i = w.find(bad, i + 1)
        return out

    def _readings(self, w: str) -> Iterator[str]:
        """Words that differ by one or two confusions."""
        first = self._near(w)
        yield from first
        if len(w) > 4:
            for f in first:
                yield from self._near(f)

    def misread(self, core: str) -> str | None:
        """What a word stands for, None when it is as it should be."""
        if core not in self.known:
            if len(self.known) > 300_000:
                self.known.clear()
            self.known[core] = self._misread(core)
        return self.known[core]

    def _misread(self, core: str) -> str | None:
        low = core.lower()
        if len(low) < 2 or len(low) > 40:
            return None
        n = self.counts.get(low, 0)
        odd = any(c in "0156!|@$øﬀﬁﬂﬃﬄ89" for c in low)
        if n > self.rare and not odd and (n > self.total * RARE * 40 or len(low) < 4):
            return None
        if not odd and "-" in low:
            return None
        if odd and not any(c.isalpha() for c in low):
            return None
        if re.fullmatch(r"\d+(?:st|nd|rd|th|s|er|e|ème)?|[a-z]\d+", low) or low.endswith("!") or low.startswith(("!", "|")):
            return None
        capital = core[0].isupper()
        # short words and names are left alone unless a sign stands among their letters
        if not odd and (len(low) < 3 or core.isupper()):
            return None
        best, score = None, 0.0
        for r in self._readings(low):
            m = self.counts.get(r, 0)
            if m > score:
                best, score = r, m
        need = max(n, 1) * (RATIO if n <= self.rare else SURE)
        if capital and not odd:  # names are rare by nature: only a word that often opens a sentence explains them
            need = max(need, self.total * RARE * 25)
        if best and score >= max(need, 5 if not odd else 3, self.rare if not odd else 0):
            return best.capitalize() if capital else best
        if odd and re.search(r"[^\W\d_][015!|@$](?=[^\W\d_])|ﬀ|ﬁ|ﬂ", low) and not n > self.rare:
            for bad, good in (("0", "o"), ("1", "l"), ("5", "s"), ("!", "i"), ("|", "l"), ("@", "a"), ("$", "s"), ("ﬀ", "ff"), ("ﬁ", "fi"), ("ﬂ", "fl")):
                low = low.replace(bad, good)
            return low.capitalize() if capital else low
        return None

    def broken(self, a: str, mark: str, b: str) -> str | None:
        """The word that a hyphen at a line's end broke, None for compounds and suspended hyphens."""
        if not b[0].islower():
            return None
        x, y = a.lower(), b.lower()
        if mark in "¬\xad":
            return None if a[-1] in "ÃÂÐÑ" else a + b  # there it is half of a wrongly decoded letter
        n = self.counts.get
        whole = n(x + y, 0)
        both = n(f"{x}-{y}", 0)
        if whole and whole >= both:
            return a + b
        if both or y in ("and", "or", "to", "und", "et", "y", "e", "o", "i", "ou", "oder"):
            return None
        fixed = self.misread(x + y)
        if fixed and n(fixed.lower(), 0) > self.rare:
            return a + b
        # two words of their own make a compound; else the halves are no words and belong together
        return None if n(x, 0) > self.rare and n(y, 0) > self.rare else a + b

    # lines

    def furniture(self, line: str, heads: tuple[str, ...], alone: bool) -> bool:
        """Whether a line is a running head or a page number. alone: nothing stands around it that it interrupts."""
        s = line.strip()
        if not s or len(s) > 90:
            return False
        # a number is among the first or last words of any folio and numbered head
        words = s.split()
        numbered = any(map(_NUMBERED.search, words if len(words) < 7 else words[:3] + words[-3:]))
        if numbered and _FOLIO.fullmatch(s) or s in ("i", "v", "x"):
            return True
        if heads and re.sub(r"\W+", " ", s).strip().lower() in heads:
            return True
        m = _HEAD.fullmatch(s) if numbered else None
        if m and titled(rest := (m.group("a") or m.group("b")).strip()):
            return True
        return not alone and titled(s) and len(s.split()) > 1 and s.isupper()

    def judge(self, text: str, heads: tuple[str, ...], kind: str = "paragraph") -> tuple[list[str], str, bool]:
        """(kinds of damage, repaired text, whether all of it is furniture)."""
        lines = text.split("\n")
        damage: set[str] = set()
        if len(lines) == 1 and kind == "paragraph" and len(text) < 90 and self.furniture(text, heads, True):
            return ["head"], "", True
        shouted = False
        if len(lines) > 1:
            shouted, kept = is_shouted(text), []
            for i, line in enumerate(lines):
                s = line.strip()
                before, after = (kept[-1].rstrip() if kept else ""), (lines[i + 1].strip() if i + 1 < len(lines) else "")
                inside = bool(before and after and not _ENDED.search(before))
                if s and self.furniture(s, heads, not inside or shouted) and (_FOLIO.fullmatch(s) is None or before or after):
                    damage.add("head")
                elif inside and not shouted and bare_title(s) and after[:1].islower() and len(s) * 2 < max(map(len, lines)) + 8:
                    damage.add("head")
                else:
                    kept.append(line)
            lines = kept
        body = " ".join(x.strip() for x in lines if x.strip()) if len(lines) > 1 else lines[0] if lines else ""
        return self.decode(body, damage, heads, shouted, text)

    # the lattice

    def edges(self, body: str, words: list[str], heads: tuple[str, ...], shouted: bool, text: str) -> list[tuple[int, int, str, float, str]]:
        """(start, end, reading, cost, kind) of the ways to read stretches of the stream other than as they stand."""
        out: list[tuple[int, int, str, float, str]] = []
        if heads:
            low = body.lower()
            for h in heads:
                if len(h) > 7 and all(w in low for w in h.split()):
                    out += self.head_edges(body, h)
        roman = not ROMAN.isdisjoint(words)
        if roman or _MARKED.search(body):
            out += self.sign_edges(body, roman, shouted, text)
        fix = self.fixed.__getitem__
        if any(map(fix, words)):
            at, last = 0, len(words) - 1
            for i, w in enumerate(words):
                end = at + len(w)
                got = fix(w)
                if got:
                    out += [(at, end, reading, cost, kind) for reading, cost, kind in got[0]]
                if i < last and w.isalpha() and (got or fix(words[i + 1])):
                    out += self.merge_edges(words, i, at, end)
                at = end + 1
        return out

    def merge_edges(self, words: list[str], i: int, at: int, end: int) -> Iterator[tuple[int, int, str, float, str]]:
        """Two or three pieces as one word, where one of them is rare."""
        whole = words[i]
        for piece in words[i + 1 : i + 3]:
            if not piece[:1].islower():
                return
            whole, end = whole + piece, end + 1 + len(piece)
            core = core_of(whole)
            fixed = core if self.counts.get(core.lower(), 0) > self.rare else self.misread(core) if core.isalpha() else None
            if fixed and self.counts.get(fixed.lower(), 0) > self.rare:
                yield at, end, whole.replace(core, fixed, 1), self.price(fixed) + MERGED + CONFUSED * (fixed != core), "misread" if fixed != core else "split"
            if not piece.isalpha():
                return

    def head_edges(self, body: str, head: str) -> Iterator[tuple[int, int, str, float, str]]:
        """A running head that line joining left in a text."""
        pattern = r"(?:\d{1,4}\s+)?" + r"[\W_]+".join(map(re.escape, head.split())) + r"(?:\s*[|·]?\s*\d{1,4}\b)?"
        for m in re.finditer(pattern, body, re.I):
            if titled(re.sub(r"[\d|·]", "", m.group()).strip()) and (m.start() > 0 or m.end() < len(body)):
                yield m.start(), m.end(), "", DROPPED, "head"

    def sign_edges(self, body: str, roman: bool, shouted: bool, text: str) -> Iterator[tuple[int, int, str, float, str]]:
        """Page numbers, capitals of running heads, words broken by a line's end, and stray signs."""
        if _FIGURE.search(body):
            for pattern in (_INLINE, _DIGIT):
                for m in pattern.finditer(body):
                    yield m.start(), m.end(), " " if pattern is _DIGIT else "", DROPPED, "head"
        for m in _PAGE.finditer(body) if roman else ():
            if self.counts.get(m.group(1), 0) <= self.rare * 10:
                yield m.start(), m.end(), " ", DROPPED, "head"
        for m in _CAPS.finditer(body) if not shouted and _CAPITALS.search(body) else ():
            got, words = m.group().strip(), len(m.group().split())
            inside = 0 < m.start() and m.end() < len(body) and body[m.start() - 2 : m.start() - 1].islower() and body[m.end() : m.end() + 2].strip()[:1].islower()
            if words > 2 and re.search(r"\d", got) or words > 3 and inside:
                if is_shouted(text):
                    break
                yield m.start(), m.end(), "", DROPPED, "head"
        for m in _BREAK.finditer(body) if "- " in body or "¬" in body or "\xad" in body else ():
            if whole := self.broken(*m.groups()):
                fixed = self.misread(core_of(whole))
                yield m.start(), m.end(), fixed or whole, 0.0, "hyphen"
        for m in _STRAY.finditer(body) if _SIGN.search(body) else ():
            yield m.start(), m.end(), " ", DROPPED, "stray"

    def decode(self, body: str, damage: set[str], heads: tuple[str, ...] = (), shouted: bool = False, text: str = "") -> tuple[list[str], str, bool]:
        """(kinds of damage, cheapest reading of the stream, False)."""
        words = body.split(" ")
        edges = self.edges(body, words, heads, shouted, text)
        if not edges:
            return sorted(damage), body, False
        # nodes are the ends of edges and of the words they touch; a word that no edge touches has one reading
        leaving: dict[int, list[tuple[int, str, float, str]]] = {}
        nodes = {0, len(body)}
        for start, end, reading, cost, kind in edges:
            leaving.setdefault(start, []).append((end, reading, cost, kind))
            nodes |= {start, end}
        at, touched = 0, []
        spans = sorted((e[0], e[1]) for e in edges)
        far = 0
        for start, end in spans:
            if start >= far:
                touched.append([start, end])
            else:
                touched[-1][1] = max(touched[-1][1], end)
            far = max(far, end)
        for start, end in touched:
            at = start
            while (at := body.find(" ", at, end)) >= 0:
                nodes |= {at, at + 1}
                at += 1
        order = sorted(nodes)
        inside = iter(touched)
        now = next(inside, None)
        best: dict[int, tuple[float, int, str, str]] = {0: (0.0, -1, "", "")}
        for i, start in enumerate(order[:-1]):
            while now and now[1] <= start:
                now = next(inside, None)
            if start not in best:
                continue
            cost = best[start][0]
            stop = order[i + 1]
            kept = body[start:stop]
            ways = leaving.get(start, [])
            core = core_of(kept.strip()) if now and now[0] <= start else ""
            for end, reading, more, kind in [*ways, (stop, kept, self.price(core) if core else self.floor if kept.strip() and now and now[0] <= start else 0.0, "")]:
                if end not in best or cost + more < best[end][0]:
                    best[end] = (cost + more, start, reading, kind)
        at, out = len(body), []
        while at > 0:
            _, before, reading, kind = best[at]
            out.append(reading)
            if kind:
                damage.add(kind)
            at = before
        read = "".join(reversed(out))
        if "head" in damage or "stray" in damage:
            read = re.sub(r" {2,}", " ", read).strip()
        if read != body and len(read) < len(body):  # a dropped stretch may have stood in a broken word, a joined word may be misread
            return self.decode(read, damage, heads, shouted, text)
        return sorted(damage), read, False


    def ending(self, text: str) -> str:
        """How a text's end lies open: empty for closed ones."""
        if text[-1:] in _SHUT or not (m := _OPEN.search(text[-80:])):
            return ""
        if m[2]:
            return "mark" if m[2] in ",;" else "hyphen"
        return "small" if self.counts.get(m[1], 0) > self.total / 1000 else "word"


def opening(text: str) -> str:
    """What a text begins with: a small letter, or something else."""
    return "small" if text[:1].islower() else "other" if text else ""


def word_counts(texts: DataFrame) -> DataFrame:
    """word, n over all rows: the lower-case word without the marks around it; also compounds and words around line ends."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got: Counter = Counter()

        def flush() -> pa.RecordBatch:
            core: Counter = Counter()
            for w, n in got.items():
                c = core_of(w).lower()
                if 0 < len(c) < 40 and c[0].isalpha():
                    core[c] += n
            got.clear()
            return pa.RecordBatch.from_arrays([pa.array(list(core), pa.string()), pa.array(list(core.values()), pa.int64())], names=["word", "n"])

        for b in batches:
            for t in b.column(0).to_pylist():
                if t:
                    got.update(t.split())
            if len(got) > 400_000:
                yield flush()
        yield flush()

    return texts.select("text").where("text is not null").mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def build_reader(texts: DataFrame) -> tuple[Reader, DataFrame | None]:
    """Counts of the most frequent words, at most LEXICON, and of all words, no more rows come to the driver; word, n of the rest if there is any."""
    counts = cut_lineage(word_counts(texts))
    total = counts.agg(F.sum("n")).first()[0] or 0
    top = most_frequent(counts, LEXICON)
    rest = counts.join(F.broadcast(top.select("word")), "word", "left_anti") if counts.count() > LEXICON else None
    top = top.toPandas()
    return Reader(dict(zip(top["word"], top["n"].astype(int))), int(total)), rest


def book_heads(books: DataFrame) -> DataFrame:
    """book_id, heads: titles and authors as a running head would have them, one row a book."""
    plain = lambda c: F.trim(F.lower(F.regexp_replace(F.regexp_replace(c, r"(?U)\W+", " "), r"_", " ")))
    return books.where("book_id is not null").groupBy("book_id").agg(F.collect_set(plain(F.col("title"))).alias("t"), F.collect_set(plain(F.col("author"))).alias("a")).select("book_id", F.array_union("t", "a").alias("heads"))


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """rec_table, book_id, rec_ord, kind, text of blocks and paragraphs."""
    b = read_table(spark, sf_dir, "blocks").select(F.lit("blocks").alias("rec_table"), "book_id", F.col("block_ord").cast("long").alias("rec_ord"), "kind", "text")
    p = read_table(spark, sf_dir, "paragraphs").select(F.lit("paragraphs").alias("rec_table"), "book_id", F.col("paragraph_index").cast("long").alias("rec_ord"), F.lit("paragraph").alias("kind"), "text")
    return b.unionByName(p)


def judged(recs: DataFrame, books: DataFrame, reader: Reader, rest: DataFrame | None = None) -> DataFrame:
    """The records' own damage: damage, repaired, furniture, and the marks at both ends that neighbours look at.

    rest: counts of words that the reader lacks. Records are then judged three times: the first two tell which of
    those words they ask for, the second as counts may lead to other questions; the third has the counts of all.
    """
    spark = recs.sparkSession
    heads = book_heads(books)
    held, run_id = spark.sparkContext.broadcast((reader.counts, reader.total)), uuid.uuid4().hex
    n = heads.count()
    schema = "rec_table string, book_id string, rec_ord long, kind string, damage array<string>, repaired string, furniture boolean, head string, tail string, size int"
    local = None
    if n <= TITLES:
        local = spark.sparkContext.broadcast({r["book_id"]: tuple(h for h in r["heads"] if h) for r in heads.collect()})  # at most TITLES short rows
    else:
        recs = recs.join(heads, "book_id", "left")

    more_words = rest is not None

    def rows_of(b: pa.RecordBatch) -> Iterator[tuple]:
        """The batch's rows; the columns that this run does without are no part of it and read as null."""
        columns = dict(zip(b.schema.names, b.columns))
        nothing = [None] * b.num_rows
        return zip(*(columns[c].to_pylist() if c in columns else nothing for c in ("key", "rec_table", "book_id", "rec_ord", "kind", "text", "heads", "words", "ns")))

    def columns_of(df: DataFrame, *names: str) -> DataFrame:
        return df.select(*names, *(c for c in ("heads", "words", "ns") if c in df.columns))

    def names_of(book: str, own: list[str] | None) -> tuple[str, ...]:
        return local.value.get(book, ()) if local else tuple(own) if own is not None else ()

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, total = held.value
        read = Reader(known := _Counts(counts), total)
        for b in batches:
            keys, asked = [], []
            for key, _, book, _, kind, text, own, words, ns in rows_of(b):
                if kind == "paragraph" and text and text.strip():
                    known.turn(read, words, ns)
                    read.judge(text.strip(), names_of(book, own))
                    of = known.missed.union(known.own)
                    keys += [key] * len(of)
                    asked += of
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(asked, pa.string())], names=["key", "word"])

    if rest is not None:
        recs = cut_lineage(recs.withColumn("key", F.monotonically_increasing_id()))
        for _ in range(2):
            asked = columns_of(recs, "key", "book_id", "kind", "text").mapInArrow(ask, "key long, word string").join(rest, "word")
            more = asked.groupBy("key").agg(F.collect_list(F.struct("word", "n")).alias("x")).select("key", F.col("x.word").alias("words"), F.col("x.n").alias("ns"))
            recs = recs.drop("words", "ns").join(more, "key", "left")

    types = [pa.string(), pa.string(), pa.int64(), pa.string(), pa.list_(pa.string()), pa.string(), pa.bool_(), pa.string(), pa.string(), pa.int32()]
    names = ["rec_table", "book_id", "rec_ord", "kind", "damage", "repaired", "furniture", "head", "tail", "size"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        read = Reader.of_run(run_id, *held.value, more_words)
        for b in batches:
            out = []
            for _, table, book, rec, kind, text, own, words, ns in rows_of(b):
                s = text.strip() if text else ""
                if kind != "paragraph" or not s:
                    out.append((table, book, rec, kind, [], None, False, s[:1], "", 0))
                    continue
                if more_words:
                    read.counts.turn(read, words, ns)
                damage, fixed, whole = read.judge(s, names_of(book, own))
                out.append((table, book, rec, kind, damage, fixed if damage else None, whole, opening(fixed), read.ending(fixed), len(fixed)))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)] if out else [pa.array([], t) for t in types], names=names)

    return columns_of(recs, "rec_table", "book_id", "rec_ord", "kind", "text").mapInArrow(run, schema)


def open_links(rows: DataFrame) -> DataFrame:
    """rec_table, book_id, rec_ord, tail, size, next: paragraphs whose end lies open, with the paragraph after them.

    The next record stands in the same range of RANGE order numbers, or opens the next range that has any; no window
    holds more than a range's records or a book's ranges.
    """
    book = ["rec_table", "book_id"]
    seen = rows.where("rec_ord is not null and book_id is not null and not furniture and (kind <> 'paragraph' or head <> '')").withColumn("range", F.floor(F.col("rec_ord") / RANGE))
    one = seen.groupBy(*book, "range", "rec_ord").agg(*[F.max(c).alias(c) for c in ("kind", "head", "tail", "size")])
    record = F.struct("rec_ord", "kind", "head", "size")
    within = one.withColumn("after", F.lead(record).over(W.partitionBy(*book, "range").orderBy("rec_ord"))).where("kind = 'paragraph' and tail <> ''")
    beyond = one.groupBy(*book, "range").agg(F.min(record).alias("first")).withColumn("beyond", F.lead("first").over(W.partitionBy(*book).orderBy("range"))).select(*book, "range", "beyond")
    linked = within.join(beyond, [*book, "range"]).withColumn("next", F.coalesce("after", "beyond"))
    return linked.where("next.kind = 'paragraph'").select(*book, "rec_ord", "tail", "size", "next")


def boundaries(links: list[tuple[str, int, str, int]]) -> list[int]:
    """For each record of a run the first record of its paragraph. links: (tail, size, head of the next, size of the next), one a boundary.

    best[j] is the cheapest division of the first j records. A paragraph pays for what it joins and for its length
    beyond LONG, a boundary between paragraphs for the open end it leaves.
    """
    sizes = [links[0][1], *(x[3] for x in links)]
    until = [0]
    for n in sizes:
        until.append(until[-1] + n)
    best, back = [0.0] * (len(sizes) + 1), [0] * (len(sizes) + 1)
    joined = 0.0  # cost of joining all records so far
    starts = [(0.0, 0)]  # (cost of a paragraph that begins at a record less what joining up to it would cost, record); none is cheaper and shorter than a later one
    for j in range(1, len(sizes) + 1):
        ways = [(g + joined + max(0.0, log((until[j] - until[i] + 1) / LONG)), -i) for g, i in starts]
        best[j], i = min(ways)
        back[j] = -i
        if j < len(sizes):
            tail, _, head, _ = links[j - 1]
            joined += 0.0 if head == "small" else CAPITAL
            g = best[j] + BREAKS[tail] - joined
            starts = [(h, i) for h, i in starts if h < g] + [(g, j)]
            least = starts[0][0]
            starts = [(h, i) for h, i in starts if h < least + log((until[-1] + 1) / LONG + 1) + 1e-9]
    out, j = [0] * len(sizes), len(sizes)
    while j > 0:
        for k in range(back[j], j):
            out[k] = back[j]
        j = back[j]
    return out


def paragraph_runs(rows: DataFrame) -> DataFrame:
    """rec_table, book_id, rec_ord, start: the records whose paragraph other records share, with the first of these."""
    book = ["rec_table", "book_id"]
    links = cut_lineage(open_links(rows))
    both = links.select(*book, "rec_ord", F.lit(False).alias("joined")).unionByName(links.select(*book, F.col("next.rec_ord").alias("rec_ord"), F.lit(True).alias("joined")))
    starts = run_starts(both.groupBy(*book, "rec_ord").agg(F.max("joined").alias("joined")))
    # one row a run of open ends: a few numbers for each of its records, no text
    link = F.struct("rec_ord", F.col("next.rec_ord").alias("next_ord"), "tail", "size", F.col("next.head").alias("head"), F.col("next.size").alias("next_size"))
    runs = links.join(starts, [*book, "rec_ord"]).groupBy(*book, "start").agg(F.sort_array(F.collect_list(link)).alias("links"))

    def divide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for table, book_id, links in zip(*(c.to_pylist() for c in b.columns)):
                ords = [links[0]["rec_ord"], *(x["next_ord"] for x in links)]
                first = boundaries([(x["tail"], x["size"], x["head"], x["next_size"]) for x in links])
                shared = Counter(first)
                out += [(table, book_id, ords[k], ords[i]) for k, i in enumerate(first) if shared[i] > 1]
            columns = zip(*out) if out else ([],) * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.string(), pa.int64(), pa.int64()))], names=["rec_table", "book_id", "rec_ord", "start"])

    return runs.select(*book, "links").mapInArrow(divide, "rec_table string, book_id string, rec_ord long, start long")


def damaged(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """(records with damage of their own, records of paragraphs that page ends cut)."""
    recs = records(spark, sf_dir)
    reader, rest = build_reader(recs.where("kind = 'paragraph'"))
    rows = cut_lineage(judged(recs, read_table(spark, sf_dir, "book_specs"), reader, rest))
    return rows, paragraph_runs(rows)


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """rec_table, book_id, rec_ord of the damaged records."""
    rows, parts = damaged(spark, sf_dir)
    own = rows.where("size(damage) > 0").select("rec_table", "book_id", "rec_ord")
    return own.unionByName(parts.select("rec_table", "book_id", "rec_ord")).distinct()


def p4_repaired(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Damaged records with their damage and the repaired text; the first part of a cut paragraph has all of it, its other parts and furniture none."""
    rows, parts = damaged(spark, sf_dir)
    keys = ["rec_table", "book_id", "rec_ord"]
    parts = cut_lineage(parts)
    # texts of parts without damage; while these are few their keys are broadcast and no other text is shuffled
    texts = records(spark, sf_dir).join(small_broadcast(parts, parts.count()), keys).groupBy(*keys).agg(F.max("text").alias("text"))
    own = rows.where("size(damage) > 0").groupBy(*keys).agg(F.max("damage").alias("damage"), F.max("repaired").alias("repaired"), F.max("furniture").alias("furniture"))
    hit = own.join(parts.join(texts, keys), keys, "full").withColumn("body", F.coalesce("repaired", F.trim(F.regexp_replace("text", r"\s*\n\s*", " "))))
    cut = F.when(F.col("start").isNotNull(), F.array(F.lit("cut"))).otherwise(F.array().cast("array<string>"))
    out = hit.select(*keys, F.concat(F.coalesce("damage", F.array().cast("array<string>")), cut).alias("damage"), "body", F.coalesce("furniture", F.lit(False)).alias("furniture"), "start")
    whole = (
        out.where("start is not null").groupBy("rec_table", "book_id", "start").agg(F.sort_array(F.collect_list(F.struct("rec_ord", "body"))).alias("parts"))
        .select("rec_table", "book_id", F.col("start").alias("rec_ord"), joined_text(F.col("parts")).alias("whole"))
    )
    later = F.coalesce(F.col("start") != F.col("rec_ord"), F.lit(False))
    return out.join(whole, keys, "left").select(*keys, "damage", F.when(later | F.col("furniture"), F.lit("")).otherwise(F.coalesce("whole", "body")).alias("repaired"))


def run_starts(halves: DataFrame) -> DataFrame:
    """rec_table, book_id, rec_ord, start: the first record of each run of neighbours; joined: the one before is of its run.

    Runs are numbered inside ranges of RANGE order numbers, then those that go on over a range's end are
    numbered over ranges; no window holds more than a range's records or a book's ranges that open with a joined record.
    """
    part = ["rec_table", "book_id"]
    r = halves.withColumn("range", F.floor(F.col("rec_ord") / RANGE))
    w = W.partitionBy(*part, "range").orderBy("rec_ord").rowsBetween(W.unboundedPreceding, 0)
    r = r.withColumn("own", F.last(F.when(~F.col("joined"), F.col("rec_ord")), ignorenulls=True).over(w))
    # the last start up to the end of each range that has one, for the ranges whose first records have none
    ends = r.groupBy(*part, "range").agg(F.max("own").alias("end"))
    before = W.partitionBy(*part).orderBy("range").rowsBetween(W.unboundedPreceding, -1)
    ends = ends.withColumn("carried", F.last("end", ignorenulls=True).over(before)).select(*part, "range", "carried")
    return r.join(ends, [*part, "range"]).select(*part, "rec_ord", F.coalesce("own", "carried", "rec_ord").alias("start"))


def joined_text(parts: F.Column) -> F.Column:
    """The bodies of a run in order; a word cut at an end goes on without its hyphen."""

    def add(text: F.Column, part: F.Column) -> F.Column:
        body = part["body"]
        return F.when(text == "", body).when(body == "", text).when(text.rlike(r"[^\W\d_][-¬\xad]$"), F.concat(F.regexp_replace(text, r"[-¬\xad]$", ""), body)).otherwise(F.concat_ws(" ", text, body))

    return F.aggregate(parts, F.lit(""), add)
