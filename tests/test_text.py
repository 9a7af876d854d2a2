import pytest
from pyspark.sql import functions as F

from quire.functions import pytext as P
from quire.functions import text as X
from quire.functions.tokens import proxy_tokens, proxy_tokens_py, word_count

BREAKS = ["* * *", "***", "~~~", "###", "- - -", "****", "⁂", "---", "...", "~", "§", "• • •"]
PROSE = ["-", "--", "*", "•", "He left.", "A B C", "", "   ", "x" * 41, "1", "* *"]


def values(spark, strings, **cols):
    df = spark.createDataFrame([(i, s) for i, s in enumerate(strings)], "i int, s string")
    return [r.asDict() for r in df.select("i", *[c.alias(n) for n, c in cols.items()]).orderBy("i").collect()]


def test_breaks(spark):
    got = values(spark, BREAKS + PROSE + [None], b=X.is_scene_break(F.col("s")), a=X.is_scene_break(F.col("s"), True))
    assert [r["b"] for r in got] == [True] * len(BREAKS) + [False] * (len(PROSE) + 1)
    assert got[len(BREAKS)]["a"] and got[len(BREAKS) + 1]["a"] and not got[len(BREAKS) + 4]["a"]
    assert [P.is_scene_break(s) for s in BREAKS + PROSE] == [True] * len(BREAKS) + [False] * len(PROSE)


TEXTS = ["  a b​c  , d \t e !", "café", "­soft­ hyphen", "", None, "x\n y", " . ", "word ", "…  and  … so", "🙂 ok ?"]


def test_cleaning_agrees_on_both_sides(spark):
    got = values(spark, TEXTS, c=X.clean_inline(F.col("s")), h=X.clean_heading(F.col("s")))
    for s, r in zip(TEXTS, got):
        assert r["c"] == (None if s is None else P.clean_inline(s))
        assert r["h"] == (None if s is None else P.clean_heading(s))
    assert P.clean_inline("a b , c") == "a b, c" and P.clean_inline("café") == "café"


def test_lines(spark):
    lines = ["Chapter 1", "PART II: The End", "Prologue", "Part of me knew.", "The chapter", "chapterhouse", None]
    assert [r["c"] for r in values(spark, lines, c=X.is_chapter_line(F.col("s")))] == [True, True, True, True, False, False, False]
    md = ["# One", "  ## Two ##", "### Three", "#x", "    # no", "# # #", None]
    got = values(spark, md, level=X.markdown_level(F.col("s")), text=X.markdown_text(F.col("s")))
    assert [r["level"] for r in got] == [1, 1, 2, None, None, 1, None]
    assert got[1]["text"] == "Two" and got[5]["text"] == "#"
    assert [r["p"] for r in values(spark, ["12", "Page 3 of 9", "page 4", "12345", "in 12"], p=X.is_page_number(F.col("s")))] == [True, True, True, False, False]
    assert [r["n"] for r in values(spark, ["1", "999", "0", "1000", " 7 "], n=X.is_numbered_break(F.col("s")))] == [True, True, False, False, True]


def test_names(spark):
    got = values(spark, ["The Mill & the Sea!", "__x__", "Äb", None], slug=X.slugify(F.col("s")), key=X.heading_key(F.col("s")))
    assert [r["slug"] for r in got] == ["the_mill_the_sea", "x", "b", None]
    assert got[0]["key"] == "the mill the sea"
    assert [r["d"] for r in values(spark, ["well-\nknown", "a- \nb", "x-\ny-\nz"], d=X.dehyphenate(F.col("s")))] == ["wellknown", "a- \nb", "xy-\nz"]
    assert [r["f"] for r in values(spark, ["Contents", "COPYRIGHT", "Notes on", None], f=X.is_furniture(F.col("s")))] == [True, True, False, False]
    assert [r["k"] for r in values(spark, ["ops/nav.xhtml", "discovery.xhtml", "ch1.xhtml"], k=X.is_skipped_part(F.col("s")))] == [True, True, False]
    got = values(spark, ["Book Two", "Volume IX: Sea", "Books", "The Boxed Set", "trilogy"], label=X.is_book_label(F.col("s")), om=X.is_omnibus_hint(F.col("s")))
    assert [r["label"] for r in got] == [True, True, False, False, False] and [r["om"] for r in got] == [False, False, False, True, True]
    assert values(spark, ["<b>A&amp;B</b>&nbsp; > "], c=X.clean_label(F.col("s")))[0]["c"] == "A&B >"


@pytest.mark.parametrize("text,n", [("one two three four", 5), ("Hi, you!", 3), ("", 0), (None, 0), ("½ ok", 3), ("a\x1cb", 1)])
def test_proxy(spark, text, n):
    got = values(spark, [text], t=proxy_tokens(F.col("s")), w=word_count(F.col("s")))[0]
    assert got["t"] == n == proxy_tokens_py(text)


def test_globs():
    import re

    assert re.search(X.glob_to_regex("sea*"), "Sea of glass") and not re.search(X.glob_to_regex("sea*"), "the sea")
    assert re.search(X.glob_to_regex("sea"), "the SEA") and re.search(X.glob_to_regex("a?[!x]"), "abc") and not re.search(X.glob_to_regex("a?[!x]"), "abx")


def test_tokenizer(tmp_path, monkeypatch):
    from quire.functions.tokenizer import load_tokenizer, verify_budget

    for v in ("QUIRE_TOKENIZER", "HF_HOME"):
        monkeypatch.delenv(v, raising=False)
    monkeypatch.setenv("HOME", str(tmp_path))
    c = load_tokenizer()
    assert not c.info.exact and c.count("a b") == 2
    with pytest.raises(RuntimeError):
        load_tokenizer(allow_proxy=False)
    with pytest.raises(RuntimeError):
        c.encode("x")
    with pytest.raises(AssertionError):
        verify_budget(c, "a b c", 1)
    from pathlib import Path

    for name in ("byte_bpe_50k.tiktoken", "byte_bpe_50k.json", "piece_bpe_32k.model"):
        p = Path("/opt/tokenizers") / name
        if p.exists():
            t = load_tokenizer(str(p))
            assert t.info.exact and len(t.info.sha256) == 64 and t.count("hello world") == len(t.encode("hello world")) > 0


def test_ornaments_are_as_many_as_the_rule_names():
    assert len(set(X.ORNAMENTS)) == len(X.ORNAMENTS) == 141 and len(set(X.STRONG)) == len(X.STRONG) == 51
    assert "\u274f" not in X.ORNAMENTS and set("*•") & set(X.STRONG) == set() and set("~†‡§¶⁂") <= set(X.STRONG)


def test_ranked_json_vocabulary(tmp_path):
    import base64
    import json

    from quire.functions.tokenizer import load_tokenizer

    tokens = [bytes([i]) for i in range(256)] + [b"ab", b"abc", b"beyond"]
    tree = {
        "config": {"pattern": r"\S+|\s+", "default_vocab_size": 268, "default_num_special_tokens": 10}, "special_tokens": [{"rank": 1, "token_str": "<s>"}, {"rank": 2, "token_str": "</s>"}],
        "vocab": [{"rank": i, "token_bytes": base64.b64encode(t).decode()} for i, t in enumerate(tokens)],
    }
    f = tmp_path / "tekken.json"
    f.write_text(json.dumps(tree))
    c = load_tokenizer(str(f))
    assert c.encode("abcd ab") == [257 + 10, ord("d") + 10, ord(" ") + 10, 256 + 10] and c.count("abcd ab") == 4 and (c.info.bos_id, c.info.eos_id, c.info.exact) == (1, 2, True)
