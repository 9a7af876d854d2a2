from collections import defaultdict

import pytest

from quire.llm import grouping as g

BOOKS = "book_id string, title string, author string, series string, group_key string, order_hint int, sources array<string>"


def test_names():
    k = g.author_key
    assert k("Odile Koduka") == k("KODUKA,  odile ") == k("Odile Kodúka") != k("Odette Koduka")
    assert k("W. Duputeld") == k("Duputeld, W.") == "duputeld w." and k("Øre Łuk") == k("ore luk")
    assert [k(x) for x in (None, "", " ", "Unknown", "N/A", "various", "_root", "-", "None")] == [None] * 9
    s = g.series_key
    assert s("The Gedotes Saga") == s("gedotes  saga, the") == s("The Gedótes-Saga (Book 2)") == s("Gedotes Saga #3") == s("Gedotes Saga, Vol. 4") != s("The Gedotes Cycle")
    assert [s(x) for x in (None, "n/a", "_root", "", "The")] == [None] * 5


def test_short_names_need_one_full_name(spark):
    resolve = lambda forms: {r["form"]: r["to"] for r in g.resolved(spark.createDataFrame([(f,) for f in forms], "form string")).collect()}
    assert resolve(["duputeld willem", "duputeld w."]) == {"duputeld w.": "duputeld willem"}
    assert resolve(["duputeld willem", "duputeld wrenna", "duputeld w."]) == {}
    assert resolve(["duputeld odile", "duputeld w.", "duputeld", "w. x."]) == {}
    assert resolve(["ann lee marie", "lee a. m.", "ann lee", "lee an.", "bo lee", "marie a. l."]) == {"lee a. m.": "ann lee marie", "marie a. l.": "ann lee marie"}


def test_short_names_equal_brute_force(spark, rng):
    names = ["ann", "anna", "lee", "leo", "mo", "a.", "l.", "an.", "m."]
    forms = set()
    while len(forms) < 120:
        words = rng.sample(names, rng.choice([2, 2, 3]))
        long = sorted(w for w in words if not w.endswith("."))
        if long:
            forms.add(" ".join([*long, *[w for w in words if w.endswith(".")]]))
    full = [f for f in forms if not f.endswith(".")]
    want = {}
    for f in forms:
        fit = {x for x in full if g.fits(f, x)} if f.endswith(".") else set()
        if len(fit) == 1:
            want[f] = fit.pop()
    got = {r["form"]: r["to"] for r in g.resolved(spark.createDataFrame([(f,) for f in sorted(forms)], "form string")).collect()}
    assert got == want


def test_tree_of_bins(spark, rng, monkeypatch):
    rows = [(f"g{i}", rng.choice([1, 2, 3, 40])) for i in range(900)]
    comps = spark.createDataFrame(rows, "group_id string, w long")
    plan = {"train": 0.8, "val": 0.1, "test": 0.1}
    total = sum(w for _, w in rows)
    for part, gathered in ((10**6, 64), (20, 4)):
        monkeypatch.setattr(g, "PART", part)
        monkeypatch.setattr(g, "GATHERED", gathered)
        got = {r["group_id"]: r["split"] for r in g.spread(comps, plan).collect()}
        assert len(got) == 900
        for s, f in plan.items():
            assert abs(sum(w for i, w in rows if got[i] == s) - f * total) < 0.02 * total
        assert got == {r["group_id"]: r["split"] for r in g.spread(comps.repartition(7), plan).collect()}


def test_groups(spark, folder):
    rows = [
        ("a1", "t", "Ann Lee", None, "s", 0, ["x.txt"]), ("a2", "t", "lee, ann", "n/a", "s", 0, ["y.txt"]), ("a3", "t", None, "The Sea Saga", "s", 0, ["x.txt", ""]), ("b1", "t", "Unknown", "Sea-Saga #2", "s", 0, None),
        ("c1", "t", "Unknown", "_root", "s", 0, []), ("c2", "t", "unknown", "", "s", 0, [None]), ("d1", "t", "A. Lee", None, "s", 0, ["q"]), ("a1", "t", "Ann Lee", None, "s", 0, ["x.txt"]), (None, "t", "Ann Lee", None, "s", 0, ["x.txt"]),
    ]
    chunk_rows = [(f"{b}::{i}", b) for b in ("a1", "a2", "a3", "b1", "c1", "c2", "d1", "new", None) for i in range(5)]
    d = folder(book_specs=(rows, BOOKS), chunks=(chunk_rows, "id string, book_id string"), split_plan=([("train", 0.6), ("val", 0.2), ("test", 0.2)], "split string, fraction double"))
    assert sorted(map(tuple, g.p6_found(spark, d).collect())) == [("a1", "a2"), ("a1", "a3"), ("a1", "b1"), ("a1", "d1")]
    got = g.p6_splits(spark, d).collect()
    by = defaultdict(set)
    for r in got:
        by[r["group_id"]].add(r["split"])
    assert len(got) == 45 and all(len(v) == 1 for v in by.values()) and {r["split"] for r in got if r["book_id"] is None} == {None}
    assert next(r["split"] for r in got if r["book_id"] == "new") in ("train", "val", "test")


def test_empty(spark, folder):
    d = folder(book_specs=([], BOOKS), chunks=([], "id string, book_id string"), split_plan=([("train", 1.0)], "split string, fraction double"))
    assert g.p6_found(spark, d).count() == 0 and g.p6_splits(spark, d).count() == 0


def test_long_chains_are_one_group(spark):
    from quire.plans.components import connected_components

    edges = [(f"n{i:04}", f"n{i + 1:04}") for i in range(300)] + [("z1", "z2"), ("z2", "z1"), ("y", "y"), (None, "y")]
    got = {r["node"]: r["component"] for r in connected_components(spark.createDataFrame(edges, "u string, v string")).collect()}
    assert {got[f"n{i:04}"] for i in range(301)} == {"n0000"} and got["z2"] == "z1" and got["y"] == "y" and None not in got


@pytest.mark.parametrize("bins", [1, 3, 16])
def test_largest_differencing(rng, bins):
    weights = [(rng.randint(1, 100), f"i{i}") for i in range(200)]
    got = g.largest_differencing(weights, bins)
    assert len(got) == bins and sorted(m for _, ms in got for m in ms) == sorted(m for _, m in weights)
    assert all(w == sum(x for x, m in weights if m in ms) for w, ms in got)
    assert max(w for w, _ in got) - min(w for w, _ in got) <= 100 / 4
    assert g.largest_differencing([], 2) == [(0, []), (0, [])]
