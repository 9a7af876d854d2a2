"""Token counters: a resolved vocabulary file, or the approximate price behind the same interface."""

from __future__ import annotations

import base64
import hashlib
import json
import os
from collections.abc import Iterator
from dataclasses import asdict, dataclass
from pathlib import Path

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from quire.functions.tokens import proxy_tokens, proxy_tokens_py

#: Fixed value: the pattern rank files split text by.
RANK_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Where a vocabulary is looked for when none is named.
SEARCH = [("QUIRE_TOKENIZER", ""), ("HF_HOME", "hub"), ("HOME", ".cache/huggingface/hub")]


@dataclass(frozen=True)
class TokenizerInfo:
    """Where counts come from."""

    kind: str
    path: str | None
    sha256: str | None
    bos_id: int | None
    eos_id: int | None
    exact: bool
    caution: str = ""

    def as_dict(self) -> dict:
        return asdict(self)

    def describe(self) -> str:
        return f"{self.kind} ({'exact' if self.exact else 'approximate'})" + (f", {self.path}" if self.path else "") + (f"; {self.caution}" if self.caution else "")

    def dumps(self) -> str:
        return json.dumps(self.as_dict(), indent=2, ensure_ascii=False)


def sha256_file(path: str | Path, block: int = 1 << 20) -> str:
    """Digest of a file, read in blocks."""
    h = hashlib.sha256()
    with open(path, "rb") as f:
        while b := f.read(block):
            h.update(b)
    return h.hexdigest()


class TokenCounter:
    """Counts and ids by one vocabulary; counts are remembered up to a bound."""

    def __init__(self, info: TokenizerInfo, encode=None, most: int = 200_000):
        self.info, self._encode, self._known, self._most = info, encode, {}, most

    def encode(self, text: str) -> list[int]:
        """Ids without boundary tokens; the approximate counter has none."""
        if self._encode is None:
            raise RuntimeError("the approximate counter cannot encode")
        return self._encode(text)

    def count(self, text: str) -> int:
        if self._encode is None:
            return proxy_tokens_py(text)
        if text not in self._known:
            if len(self._known) >= self._most:
                self._known.clear()
            self._known[text] = len(self._encode(text)) if text else 0
        return self._known[text]

    @property
    def additive(self) -> bool:
        """Whether words and marks of texts add up to those of the whole: the approximate counter."""
        return self._encode is None

    def count_many(self, texts: list[str]) -> list[int]:
        return [self.count(t) for t in texts]


def _probe(encode, bos: str = "<s>", eos: str = "</s>") -> tuple[int | None, int | None]:
    """Ids of the boundary tokens, when their strings are single tokens of the vocabulary."""
    return tuple(ids[0] if len(ids := encode(t)) == 1 else None for t in (bos, eos))


def _load(path: Path):
    """(kind, encode, bos, eos) of a vocabulary file."""
    if path.suffix == ".tiktoken":
        import tiktoken

        ranks = {base64.b64decode(a): int(b) for a, b in (x.split() for x in path.read_bytes().splitlines() if x)}
        enc = tiktoken.Encoding(path.stem, pat_str=RANK_PATTERN, mergeable_ranks=ranks, special_tokens={})
        return "ranks", enc.encode_ordinary, None, None
    if path.suffix == ".model":
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=str(path))
        return "pieces", lambda t: sp.encode(t, num_threads=1), sp.bos_id(), sp.eos_id()
    if (ranked := _ranked_json(path)) is not None:
        return ranked
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(str(path))
    encode = lambda t: tok.encode(t, add_special_tokens=False).ids
    return "tokenizer.json", encode, *_probe(encode)


def _ranked_json(path: Path):
    """What _load gives for a JSON file of ranked byte strings (config, vocab, special_tokens); None for other files.

    Special tokens come first among the ids, so the id of a byte string is its rank behind them.
    """
    try:
        tree = json.loads(path.read_text(encoding="utf-8"))
    except (UnicodeDecodeError, ValueError):
        return None
    if not isinstance(tree, dict) or not {"config", "vocab"} <= set(tree):
        return None
    import tiktoken

    config = tree["config"]
    special = int(config.get("default_num_special_tokens", 0))
    size = int(config.get("default_vocab_size", len(tree["vocab"]) + special)) - special
    ranks = {base64.b64decode(v["token_bytes"]): int(v["rank"]) for v in tree["vocab"] if int(v["rank"]) < size}
    enc = tiktoken.Encoding(path.stem, pat_str=config.get("pattern", RANK_PATTERN), mergeable_ranks=ranks, special_tokens={})
    named = {t.get("token_str"): int(t["rank"]) for t in tree.get("special_tokens") or []}
    return "ranked json", lambda t: [i + special for i in enc.encode_ordinary(t)], named.get("<s>", 1 if special > 1 else None), named.get("</s>", 2 if special > 2 else None)


def find_vocabulary(names: tuple[str, ...] = ("tokenizer.json", "tekken.json")) -> Path | None:
    """The first vocabulary at the usual places."""
    for variable, below in SEARCH:
        root = os.environ.get(variable)
        if not root:
            continue
        p = Path(root) / below if below else Path(root)
        if p.is_file():
            return p
        if p.is_dir():
            for name in names:
                if found := sorted(p.rglob(name)):
                    return found[0]
    return None


def load_tokenizer(path: str | None = None, allow_proxy: bool = True) -> TokenCounter:
    """The named vocabulary, else one at the usual places, else the approximate counter where that is allowed."""
    p = Path(path) if path else find_vocabulary()
    if path and not p.is_file():
        raise RuntimeError(f"no vocabulary at {path}")
    if p:
        kind, encode, bos, eos = _load(p)
        return TokenCounter(TokenizerInfo(kind, str(p), sha256_file(p), bos, eos, True), encode)
    if not allow_proxy:
        raise RuntimeError("no vocabulary found and the approximate counter is not allowed")
    return TokenCounter(TokenizerInfo("proxy", None, None, None, None, False, "counts are approximate"))


def verify_budget(counter: TokenCounter, text: str, limit: int) -> int:
    """The count of a text, which must not exceed a limit."""
    n = counter.count(text)
    if n > limit:
        raise AssertionError(f"{n} tokens exceed {limit}")
    return n


def token_count(text: Column, path: str | None = None) -> Column:
    """Counts of a column: JVM-side for the approximate counter, one Arrow batch at a time for a vocabulary."""
    if path is None:
        return proxy_tokens(text)

    @F.pandas_udf("int")
    def count(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        c = load_tokenizer(path)
        for b in batches:
            yield b.map(lambda t: 0 if t is None else c.count(t)).astype("int32")

    return count(text)


def token_ids(text: Column, path: str) -> Column:
    """Ids of a column without boundary tokens; null texts have none."""

    @F.pandas_udf("array<int>")
    def encode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        c = load_tokenizer(path)
        for b in batches:
            yield b.map(lambda t: [] if not t else c.encode(t))

    return encode(text)
