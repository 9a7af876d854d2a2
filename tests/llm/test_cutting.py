import pytest
from tables import BUDGETS, CHUNKS, PARAGRAPHS, SCENES, WORDS

from quire.functions.tokens import proxy_tokens_py as price
from quire.llm import cutting as c


def check(text, capacity, overlap):
    pieces = c.cut_text(text, capacity, overlap)
    assert all(price(text[a:b]) == t <= capacity and o <= overlap for a, b, t, o in pieces)
    at = 0
    for a, b, _, _ in pieces:
        assert a <= at or not text[at:a].strip()
        assert b > at
        at = b
    assert not text[at:].strip()
    return pieces


@pytest.mark.parametrize("capacity,overlap", [(40, 0), (40, 8), (100, 32), (7, 2)])
def test_pieces_cover_and_fit(rng, capacity, overlap):
    text = ""
    for _ in range(30):
        text += " ".join(rng.choice(WORDS) for _ in range(rng.randint(1, 25))) + rng.choice([". ", "! ", "\n\n", ", ", ".\n\n"])
    pieces = check(text, capacity, overlap)
    assert len(pieces) > 1
    if overlap > 2:
        assert any(o for *_, o in pieces)


def test_boundaries_are_natural(rng):
    paras = [" ".join(rng.choice(WORDS) for _ in range(12)) + "." for _ in range(20)]
    text = "\n\n".join(paras)
    assert all(text[b : b + 2] in ("\n\n", "") for _, b, _, _ in check(text, 64, 0))


def test_a_change_of_topic_is_cut_there():
    a, b = "ships sailed across stormy seas. sailors hauled ropes aboard ships. " * 5, "bakers kneaded fresh dough. ovens baked warm loaves daily. " * 5
    (_, end, _, _), *_ = check(a + b, 130, 0)
    assert end == len(a.rstrip())


def test_edges():
    assert c.cut_text(None, 10, 0) == [] and c.cut_text("", 10, 0) == [] and c.cut_text(" \n", 10, 0) == []
    assert len(c.cut_text("short text", 10, 0)) == 1
    check("word " * 5000, 50, 10)
    for a, b, t, _ in c.cut_text("!" * 500, 20, 0):
        assert t <= 20
    check("x" * 10_000 + " y", 10, 0)


def test_queries(spark, folder, monkeypatch):
    budgets = [("cut", "paragraph", 20, 4, 0), ("cut", "scene", 30, 0, 1), ("cut", "chunk", 25, 5, 1), ("pack", "chunk", 1, 0, 0)]
    long, short = "one two three. " * 12, "one two"
    paragraphs = [("b", 0, 0, 0, long, 1, 1), ("b", 0, 0, 0, long, 1, 1), ("b", 0, 0, 1, short, 99, 1), ("b", 0, 0, 2, None, None, None), ("b", 0, 1, 3, short, 1, 1)]
    scenes = [("b", 0, 0, None, [(0, None), (1, 1), (2, None)], 3, 1), ("b", 0, 1, [], [(3, 500)], 1, 1), ("b", 0, 2, [], None, None, None), ("b", 0, 0, None, [(0, None), (1, 1), (2, None)], 3, 1)]
    chunks = [("k1", long, 1, "b", None), ("k1", long, 1, "b", None), ("k2", short, 999, "b", None), (None, None, None, None, None)]
    d = folder(paragraphs=(paragraphs, PARAGRAPHS), scenes=(scenes, SCENES), chunks=(chunks, CHUNKS), budgets=(budgets, BUDGETS))
    want = [("chunk", "k1"), ("paragraph", "b::0"), ("scene", "b::0::0")]
    assert sorted(map(tuple, c.p5_found(spark, d).collect())) == want
    rows = c.p5_pieces(spark, d).collect()
    assert sorted({(r["item_level"], r["item_key"]) for r in rows}) == want and all(price(r["text"]) == r["n_tokens"] for r in rows)
    caps = {lv: cap for _, lv, cap, _, _ in budgets[:3]}
    assert all(r["n_tokens"] <= caps[r["item_level"]] and r["n_pieces"] > 1 for r in rows)
    monkeypatch.setattr(c, "small_broadcast", lambda df, n: df)  # beyond the limit a join fetches the scenes' paragraphs
    assert sorted(map(tuple, c.p5_pieces(spark, d).collect())) == sorted(map(tuple, rows))
