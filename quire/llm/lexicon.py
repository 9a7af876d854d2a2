"""A minimal acyclic transducer from words to token ids, kept in flat arrays that can be memory-mapped."""

from __future__ import annotations

import heapq
from collections.abc import Iterable

import numpy as np

MAGIC = 0x51554952


def _freeze(states: list[tuple[bool, tuple[tuple[int, int], ...]]], root: int, words: list[tuple[bytes, tuple[int, ...]]]) -> bytes:
    """Arrays of the automaton and the id lists, as one block of int32.

    An arc carries the number of accepted words before its target's, so a word's arcs add up to its rank, and
    ranks address the id lists: equal suffixes share states although their outputs differ.
    """
    below = [0] * len(states)
    for i, (final, arcs) in enumerate(states):  # targets have smaller numbers
        below[i] = final + sum(below[t] for _, t in arcs)
    first, label, target, skip = [0], [], [], []
    for final, arcs in states:
        n = int(final)
        for byte, t in arcs:
            label.append(byte)
            target.append(t)
            skip.append(n)
            n += below[t]
        first.append(len(label))
    at = np.zeros(len(words) + 1, dtype=np.int32)
    np.cumsum([len(ids) for _, ids in words], out=at[1:])
    flat = np.fromiter((i for _, ids in words for i in ids), dtype=np.int32, count=int(at[-1]))
    parts = [np.array(x, dtype=np.int32) for x in (first, [f for f, _ in states], label, target, skip)] + [at, flat]
    head = np.array([MAGIC, root, *map(len, parts)], dtype=np.int32)
    return b"".join(p.tobytes() for p in (head, *parts))


def compile_lexicon(entries: Iterable[tuple[bytes, tuple[int, ...]]]) -> bytes:
    """Daciuk's construction over sorted words: states with equal right languages are registered once."""
    words = sorted(dict(entries).items())
    register: dict = {}
    states: list[tuple[bool, tuple[tuple[int, int], ...]]] = []

    def settle(final: bool, arcs: list[tuple[int, int]]) -> int:
        key = (final, tuple(arcs))
        if key not in register:
            register[key] = len(states)
            states.append(key)
        return register[key]

    path: list[list] = [[False, []]]  # states of the last word that may still grow: final, settled arcs
    last = b""
    for word, _ in words:
        common = 0
        while common < min(len(word), len(last)) and word[common] == last[common]:
            common += 1
        while len(path) > common + 1:
            final, arcs = path.pop()
            path[-1][1].append((last[len(path) - 1], settle(final, arcs)))
        path += [[False, []] for _ in range(len(word) - common)]
        path[-1][0] = True
        last = word
    while len(path) > 1:
        final, arcs = path.pop()
        path[-1][1].append((last[len(path) - 1], settle(final, arcs)))
    return _freeze(states, settle(*path[0]), words) if states or words else _freeze([(False, ())], 0, [])


class Lexicon:
    """Look-ups in a compiled lexicon; the block may be bytes or a memory map."""

    def __init__(self, block: bytes | np.ndarray):
        data = np.frombuffer(block, dtype=np.int32) if isinstance(block, bytes | bytearray) else block
        if int(data[0]) != MAGIC:
            raise ValueError("not a lexicon")
        self.root, sizes = int(data[1]), [int(x) for x in data[2:9]]
        at, parts = 9, []
        for n in sizes:
            parts.append(data[at : at + n])
            at += n
        # views on the block without a copy; only the labels are copied, to bytes, for a search in C
        self.first, self.final, _, self.target, self.skip, self.at, self.flat = (memoryview(p) for p in parts)
        self.label = parts[2].astype(np.uint8).tobytes()

    def get(self, word: bytes) -> list[int] | None:
        """Ids of a word, None when the lexicon lacks it."""
        state, rank = self.root, 0
        first, find, skip, target = self.first, self.label.find, self.skip, self.target
        for byte in word:
            i = find(byte, first[state], first[state + 1])
            if i < 0:
                return None
            rank += skip[i]
            state = target[i]
        return self.flat[self.at[rank] : self.at[rank + 1]].tolist() if self.final[state] else None


def merge_word(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Exact byte-pair merges: always the leftmost pair of the lowest rank. A heap keeps long words near linear."""
    whole = ranks.get(word)
    if whole is not None:
        return [whole]
    parts = [word[i : i + 1] for i in range(len(word))]
    n = len(parts)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    heap = [(r, i, parts[i] + parts[i + 1]) for i in range(n - 1) if (r := ranks.get(parts[i] + parts[i + 1])) is not None]
    heapq.heapify(heap)
    while heap:
        _, i, pair = heapq.heappop(heap)
        j = after[i] if parts[i] else n
        if j >= n or parts[i] + parts[j] != pair:
            continue
        parts[i], parts[j] = pair, b""
        after[i] = after[j]
        if after[i] < n:
            before[after[i]] = i
            if (r := ranks.get(pair + parts[after[i]])) is not None:
                heapq.heappush(heap, (r, i, pair + parts[after[i]]))
        if (h := before[i]) >= 0 and (r := ranks.get(parts[h] + pair)) is not None:
            heapq.heappush(heap, (r, h, parts[h] + pair))
    return [ranks[p] for p in parts if p]
