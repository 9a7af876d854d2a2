"""Token prices as JVM-side expressions."""

from __future__ import annotations

import functools
import zlib

import numpy as np
import regex
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

#: Window of the target model, boundary tokens kept free, what is left for content.
MAX_SEQ_LEN, RESERVED_TOKENS, CONTENT_BUDGET = 8192, 2, 8190
#: Surcharge a word, price of a punctuation mark.
WORD_SURCHARGE, MARK_PRICE = 0.30, 0.5

_WORD = regex.compile(r"\S+")
_MARK = regex.compile(r"[^\w\s]")
_SPACE = regex.compile(r"\s")
#: Characters measured at a time.
_SPAN = 200_000


def proxy_tokens(text: Column) -> Column:
    """Approximate token count: words, 30 % on top, half a token a punctuation mark.

    Null and blank texts count 0.
    """
    words = F.regexp_count(text, F.lit(r"(?U)\S+")).cast("double")
    marks = F.regexp_count(text, F.lit(r"(?U)[^\w\s]")).cast("double")
    return F.coalesce((words + F.lit(WORD_SURCHARGE) * words + F.lit(MARK_PRICE) * marks).cast("int"), F.lit(0))


def proxy_tokens_py(text: str | None) -> int:
    """The same price on the Python side, for code that already runs in a worker."""
    if not text:
        return 0
    return price(len(_WORD.findall(text)), len(_MARK.findall(text)))


@functools.cache
def _own_signs() -> np.ndarray:
    """By code point: 1 for white space, 2 for punctuation, as the patterns have it."""
    points = [p for p in range(0x110000) if not 0xD800 <= p < 0xE000]
    every = "".join(map(chr, points))
    table = np.zeros(0x110000, np.uint8)
    table[0xD800:0xE000] = [2 if _MARK.match(chr(p)) else 0 for p in range(0xD800, 0xE000)]
    for pattern, value in ((_SPACE, 1), (_MARK, 2)):
        table[[ord(c) for c in pattern.findall(every)]] = value
    return table


@functools.cache
def _packed_signs(jvm) -> bytes:
    table = _own_signs().copy()
    every = np.delete(np.arange(0x110000, dtype=np.uint32), np.s_[0xD800:0xE000])
    rest = jvm.java.util.regex.Pattern.compile(r"(?U)[^\w\s]").matcher(every.tobytes().decode("utf-32-le")).replaceAll("")
    table[np.setdiff1d(every, np.frombuffer(rest.encode("utf-32-le"), np.uint32))] |= 4
    return zlib.compress(table.tobytes(), 1)


def packed_signs(spark: SparkSession) -> bytes:
    """What `measures` reads, for a closure: signs as the worker counts them and, from the driver's JVM, as `proxy_tokens` does."""
    return _packed_signs(spark.sparkContext._jvm)


def measures(texts: list[str], signs: np.ndarray | None = None) -> list[tuple[int, int, int]]:
    """(words, punctuation marks, marks by the JVM) of each text, as the prices count them; without signs the last is 0."""
    table, got, at = _own_signs() if signs is None else signs, [], 0
    while at < len(texts):
        end, size = at, 0
        while end < len(texts) and (end == at or size + len(texts[end]) < _SPAN):
            size += len(texts[end]) + 1
            end += 1
        kinds = table[np.frombuffer("\n".join(["", *texts[at:end], ""]).encode("utf-32-le", "surrogatepass"), np.uint32)]
        ends = np.cumsum([0, *(len(t) + 1 for t in texts[at:end])])
        space = kinds & 1 > 0
        starts = np.append(False, ~space[1:] & space[:-1])
        got += zip(*(np.diff(np.searchsorted(np.flatnonzero(x), ends, side="right")).tolist() for x in (starts, kinds & 2 > 0, kinds & 4 > 0)))
        at = end
    return got


def read_signs(packed: bytes) -> np.ndarray:
    return np.frombuffer(zlib.decompress(packed), np.uint8)


def price(words: int, marks: int) -> int:
    return int(words + WORD_SURCHARGE * words + MARK_PRICE * marks)


def word_count(text: Column) -> Column:
    """Words between white space; null counts 0."""
    return F.coalesce(F.regexp_count(text, F.lit(r"(?U)\S+")), F.lit(0))
