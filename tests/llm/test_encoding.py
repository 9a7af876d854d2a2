from pathlib import Path

import pytest

from quire.llm import encoding as e
from quire.llm.lexicon import Lexicon, compile_lexicon, merge_word

if not Path(e.TOKENIZERS, "byte_bpe_50k.tiktoken").exists():
    pytest.skip("no vocabulary here", allow_module_level=True)
TEXTS = [
    None, "", " ", "\n", "a", "Hello world", "  two  blanks ", "a \n b", "a\n\n  b", "tab\t\tx", "it's we'll I'D", "…—“”", "日本語 text", "🙂🙃 👩‍👩‍👧", "x" * 5000, "." * 3000, "\x00\x1c\x85 　z", "<|endoftext|>", "é é ½²",
    "end ", "   x", "ab" * 2000 + " c", "1234567890 12", "a  \t b   c", "\r\n\r\n x",
]


@pytest.fixture(scope="module")
def truth():
    import tiktoken

    enc = tiktoken.Encoding("own", pat_str=e.PATTERN, mergeable_ranks=e.read_ranks(), special_tokens={})
    return lambda t: enc.encode_ordinary(t) if t else []


@pytest.mark.parametrize("size", [3, 60_000])
def test_ids_equal_the_library(spark, truth, size):
    docs = spark.createDataFrame([(i, t, "k") for i, t in enumerate(TEXTS + TEXTS)], "doc_id long, text string, ids_of string")
    got = {r["doc_id"]: r["ids"] for r in e.encode_documents(docs, size=size).collect()}
    assert len(got) == 2 * len(TEXTS) and all(got[i] == truth(t) for i, t in enumerate(TEXTS + TEXTS))


def test_random_texts(truth, rng):
    ranks = e.read_ranks()
    enc = e.Encoder(Lexicon(compile_lexicon([(b" the", (262,))])), ranks)
    for _ in range(400):
        t = "".join(rng.choice(" \n\tabcdeéß12.,'’s日🙂 ") for _ in range(rng.randint(0, 60)))
        assert enc.encode(t) == truth(t), repr(t)


def test_lexicon(rng):
    words = {bytes(rng.choice(b"abc") for _ in range(rng.randint(1, 6))): tuple(rng.randint(0, 99) for _ in range(rng.randint(1, 4))) for _ in range(300)}
    block = compile_lexicon(words.items())
    lex = Lexicon(block)
    assert all(lex.get(w) == list(ids) for w, ids in words.items())
    assert all(lex.get(w + b"z") is None for w in words) and lex.get(b"") is None and Lexicon(compile_lexicon([])).get(b"a") is None
    shared = compile_lexicon([(w + b"ing", (1,)) for w in (b"walk", b"talk", b"sing")])
    assert len(Lexicon(shared).final) < sum(map(len, (b"walking", b"talking", b"singing")))


def test_merges_of_long_words(truth):
    ranks = e.read_ranks()
    for w in ("antidisestablishmentarianism" * 30, "zq" * 700, "é" * 900):
        assert merge_word(w.encode(), ranks) == truth(w)


def test_empty_table(spark, folder):
    d = folder(documents=([], "doc_id long, text string"))
    assert e.p7_ids(spark, d).count() == 0
