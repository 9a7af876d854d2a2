import random

import pytest

from quire.functions.pytext import text_blocks
from quire.operators import checks, running, splits, stats, structure

SCHEMA = "book_id string, block_ord long, kind string, text string, level int"


def fold(rows):
    """Sequential form of the hierarchy."""
    out, chapter, last, paras, q, qc, broke, scene = [], 0, 0, 0, None, None, False, 0
    for o, kind, text, level in rows:
        if kind == "heading" and level <= 1:
            chapter += paras > last
            last = paras
            out.append((chapter, None, o, "chapter_heading", text, None))
        elif kind == "scene_break":
            broke = True
        else:
            if q is None or qc != chapter:
                scene = 0
            elif kind == "heading" and q == "paragraph" or kind == "paragraph" == q and broke:
                scene += 1
            out.append((chapter, scene, o, "paragraph" if kind == "paragraph" else "scene_heading", text, paras if kind == "paragraph" else None))
            q, qc, broke = kind, chapter, False
            paras += kind == "paragraph"
    dense = {c: i for i, c in enumerate(sorted({r[0] for r in out}))}
    return [(dense[c], *rest) for c, *rest in out]


@pytest.mark.parametrize("segmented", [False, True])
def test_hierarchy_equals_the_fold(spark, monkeypatch, segmented):
    monkeypatch.setattr(structure, "SEGMENT", 5)
    rng, data, want = random.Random(3), [], []
    for b in range(120):
        rows = []
        for o in range(rng.randint(1, 30)):
            kind = rng.choice(["heading", "paragraph", "paragraph", "scene_break"])
            rows.append((o, kind, "" if kind == "scene_break" else f"t{o}", rng.choice([1, 1, 2]) if kind == "heading" else 0))
        data += [(f"b{b:03}", *r) for r in rows] * (1 + b % 2)  # repeated rows
        want += [(f"b{b:03}", *r) for r in fold(rows)]
    got = structure.hierarchy(spark.createDataFrame(data, SCHEMA), segmented).collect()
    assert sorted(map(tuple, got), key=lambda r: (r[0], r[3])) == sorted(want, key=lambda r: (r[0], r[3]))


def test_hierarchy_of_nothing_and_nulls(spark):
    assert structure.hierarchy(spark.createDataFrame([], SCHEMA)).count() == 0
    odd = spark.createDataFrame([("b", 0, "paragraph", None, None), ("b", 1, "scene_break", None, None), (None, 2, "paragraph", "x", 0), ("b", None, "paragraph", "x", 0), ("b", 3, "paragraph", "y", None)], SCHEMA)
    assert [r["text"] for r in structure.hierarchy(odd).collect()] == ["y"]


def test_two_headings_before_prose_share_a_chapter(spark):
    rows = [("b", 0, "heading", "Part One", 1), ("b", 1, "heading", "Chapter One", 1), ("b", 2, "paragraph", "x", 0), ("b", 3, "heading", "Chapter Two", 1), ("b", 4, "paragraph", "y", 0)]
    got = structure.chapters_of(structure.hierarchy(spark.createDataFrame(rows, SCHEMA))).orderBy("chapter_index").collect()
    assert [r["headings"] for r in got] == [["Part One", "Chapter One"], ["Chapter Two"]]


LINES = ["prose line", "broken words-", "  ", "", "Chapter One", "Part of me knew.", "* * *", "## Head ##", "### Sub", "~", "7", "Page 3", "A long one , with marks !", "...", "co-", "operate now", None]


def test_text_blocks_equal_the_line_reader(spark):
    rng = random.Random(5)
    docs = [(i, "\n".join(x for x in (rng.choice(LINES) for _ in range(rng.randint(1, 25))) if x is not None)) for i in range(150)] + [(900, ""), (901, "\r\nx\r\n"), (902, None)]
    for options in ({}, {"aggressive": True, "numbered": True, "strip_pages": True}):
        got = {}
        for r in structure.text_blocks(spark.createDataFrame(docs, "doc_id int, text string"), "doc_id", **options).orderBy("doc_id", "block_ord").collect():
            got.setdefault(r["doc_id"], []).append((r["kind"], r["text"], r["level"]))
        for i, t in docs:
            assert got.get(i, []) == (text_blocks(t, **options) if t else []), t


def test_running_heads(spark):
    b = spark.createDataFrame([("b", 0, "heading", "THE MILL", 1), ("b", 1, "heading", "Contents", 1), ("b", 2, "heading", "One", 1), ("b", 3, "paragraph", "The Mill", 0)], SCHEMA)
    kept = structure.drop_running_heads(b, spark.createDataFrame([("b", "The Mill!")], "book_id string, title string"))
    assert sorted(r["block_ord"] for r in kept.collect()) == [2, 3]


def test_running_and_global_sums(spark):
    rows = [("k", i, 1 + i % 3) for i in range(50)] + [(None, 0, 4)]
    df = spark.createDataFrame(rows, "k string, o int, v int").selectExpr("*", "floor(o / 7) as seg")
    from pyspark.sql import functions as F

    got = {(r["k"], r["o"]): r["s"] for r in running.running(df, ["k"], ["o"], "seg", s=("sum", F.col("v"))).collect()}
    total = 0
    for k, o, v in rows[:50]:
        total += v
        assert got[(k, o)] == total
    assert got[(None, 0)] == 4
    ends = [r["e"] for r in running.global_running_sum(spark.createDataFrame(rows[:50], "k string, o int, v int"), ["o"], "v", "e").orderBy("o").collect()]
    assert ends[-1] == total and ends == sorted(ends)


CHUNK = "id string, book_id string, order_in_book int, chapter_index int, paragraph_index_start int, paragraph_index_end int, paragraph_index_gaps array<int>, n_tokens int, source_files array<string>"


def test_checks(spark):
    c = spark.createDataFrame([("a", "b", 0, 0, 0, 3, [1], 5, ["x"]), ("c", "b", 1, 0, 1, 1, [], 9, ["x", "x"]), ("d", "b", 2, 1, 0, 0, None, 5, None), ("e", "b", 3, 1, -1, -1, [], None, [])], CHUNK)
    assert [r["id"] for r in checks.over_budget(c, 6).collect()] == ["c"]
    assert [r["paragraph_index"] for r in checks.repeated_paragraphs(c).collect()] == [0]
    assert sorted(r["id"] for r in checks.out_of_order(c).collect()) == ["d", "e"]
    assert [r["id"] for r in checks.repeated_sources(c).collect()] == ["c"]
    with pytest.raises(AssertionError):
        checks.verify(c, 100)
    checks.verify(c.limit(0), 1)
    p = spark.createDataFrame([("b", i) for i in (0, 2, 5, 5, 5000)], "book_id string, paragraph_index int")
    assert checks.index_gaps(p).count() == 1 + 2 + 4994


def test_splits(spark):
    books = spark.createDataFrame([(f"b{i:02}",) for i in range(25)] + [(None,), ("b00",)], "book_id string")
    assert splits.choose_val_books(books, 0.1).count() == 2  # 2.5 goes to the even number
    assert splits.choose_val_books(books.limit(1), 0.5).count() == 0 and splits.choose_val_books(books, 0.0).count() == 0 and splits.choose_val_books(books.limit(0), 0.5).count() == 0
    assert [r["book_id"] for r in splits.choose_val_books(books, named=["B07"]).collect()] == ["b07"]
    with pytest.raises(ValueError):
        splits.choose_val_books(books, named=["nope"])
    import hashlib

    u = {r["book_id"]: r["u"] for r in books.where("book_id is not null").select("book_id", splits.stable_unit(books["book_id"]).alias("u")).collect()}
    assert all(abs(v - int(hashlib.sha1(k.encode()).hexdigest()[:12], 16) / 16**12) < 1e-15 for k, v in u.items())
    c = spark.createDataFrame([("b01", 0), ("b02", 1)], "book_id string, chapter_index int")
    assert {r["split"] for r in splits.assign_splits(c, "none").collect()} == {"train"}
    with pytest.raises(ValueError):
        splits.assign_splits(c, "odd")


def test_stats(spark):
    v = [1, 2, 2, 3, 10, None]
    got = stats.length_summary(spark.createDataFrame([(x,) for x in v], "n_tokens int")).first()
    s = sorted(x for x in v if x)
    assert [got[f"p{p:02}"] for p in (5, 25, 50, 75, 95)] == [s[round(p / 100 * 4)] for p in (5, 25, 50, 75, 95)] and got["mean"] == 3.6
    assert stats.length_summary(spark.createDataFrame([], "n_tokens int")).first()["n"] == 0
    o = spark.createDataFrame([("x", "excluded", 5), ("x", "split", 7), ("y", "excluded", 1)], "kind string, action string, n_tokens int")
    assert {r["kind"]: (r["n"], r["actions"]) for r in stats.oversize_by_kind(o).collect()} == {"x": (2, {"excluded": 1, "split": 1}), "y": (1, {"excluded": 1})}
    assert stats.excluded_fraction(spark.createDataFrame([(94,)], "n_tokens int"), o).first()["fraction"] == 0.06
