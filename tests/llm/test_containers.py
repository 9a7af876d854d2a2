import numpy as np
from tables import BUDGETS, CHUNKS, PARAGRAPHS, SCENES

from quire.llm import packing as p
from quire.llm.items import all_items

BUDGET = [("pack", "paragraph", 20, 0, 1), ("pack", "scene", 40, 0, 1), ("pack", "chunk", 60, 0, 0), ("cut", "chunk", 10, 2, 0), ("pack", "odd", None, 0, 0)]


def words(n):
    return " ".join(["w"] * n)


def placed(patterns, lengths):
    out = np.zeros(len(lengths), np.int64)
    for copies, pattern in patterns:
        for i, k in pattern.items():
            out[i] += copies * k
    return out


def test_solve_places_every_item_once(rng):
    for _ in range(25):
        capacity = rng.choice([10, 57, 300])
        lengths = np.array(sorted(rng.sample(range(1, capacity + 1), rng.randint(1, min(9, capacity)))))
        counts = np.array([rng.randint(1, 60) for _ in lengths])
        out, least = p.solve(lengths, counts, capacity)
        assert (placed(out, lengths) == counts).all() and all(sum(k * lengths[i] for i, k in x.items()) <= capacity for _, x in out)
        bins = sum(k for k, _ in out)
        assert -(-int(lengths @ counts) // capacity) <= least <= bins <= bfd(lengths, counts, capacity)


def test_best_fit_equals_item_by_item(rng):
    for _ in range(40):
        capacity = rng.choice([10, 57, 300])
        lengths = np.array(sorted(rng.sample(range(1, capacity + 1), rng.randint(1, min(12, capacity)))))
        counts = np.array([rng.randint(0, 40) for _ in lengths])
        out = p.best_fit(lengths, counts, capacity)
        assert (placed(out, lengths) == counts).all() and sum(k for k, _ in out) == bfd(lengths, counts, capacity)


def test_counts_of_any_size(rng):
    lengths = np.arange(3, 90)
    counts = np.array([rng.randint(1, 10**9) for _ in lengths])
    out, least = p.solve(lengths, counts, 256)
    assert (placed(out, lengths) == counts).all() and least <= sum(k for k, _ in out) <= 1.01 * least and len(out) < 2_000


def bfd(lengths, counts, capacity):
    rooms = []
    for n, k in sorted(zip(lengths, counts), reverse=True):
        for _ in range(k):
            i = min((i for i, r in enumerate(rooms) if r >= n), key=lambda i: rooms[i], default=None)
            if i is None:
                rooms.append(capacity - n)
            else:
                rooms[i] -= n
    return len(rooms)


def test_little_space_is_left(rng):
    lengths = np.arange(5, 100)
    counts = np.array([rng.randint(0, 80) for _ in lengths])
    lengths, counts = lengths[counts > 0], counts[counts > 0]
    out, _ = p.solve(lengths, counts, 512)
    assert lengths @ counts / (512 * sum(k for k, _ in out)) > 0.985


def test_assignments(spark, folder, rng):
    paragraphs = [("b", 0, 0, i, words(rng.randint(0, 14)), None, 5) for i in range(200)] + [("b", 0, 0, 200, words(100), 1, 1), ("b", 0, 0, 201, None, None, None), (None, None, None, None, "x y", 1, 1)]
    paragraphs += paragraphs[:5]
    scenes = [("b", 0, s, None, [(i, None) for i in range(s * 3, s * 3 + 3)], 3, None) for s in range(30)] * 2 + [("b", 1, 0, [], None, 0, 0), ("b", 1, 1, [], [], 0, 0), ("q", 0, 0, [], [(7, 9), (8, None)], 2, 1)]
    chunks = [(f"c{i}", words(rng.randint(1, 30)), None, "b", None) for i in range(50)] + [("c0", words(3), None, "b", None), (None, None, None, None, None)]
    d = folder(paragraphs=(paragraphs, PARAGRAPHS), scenes=(scenes, SCENES), chunks=(chunks, CHUNKS), budgets=(BUDGET, BUDGETS))
    items = {(r["item_level"], r["item_key"]): r["n"] for r in all_items(spark, d).collect()}
    rows = p.p3_assignments(spark, d).collect()
    placed, load, kinds = {}, {}, {k: (c, s) for _, k, c, _, s in BUDGET[:3]}
    for r in rows:
        key = (r["item_level"], r["item_key"])
        placed.setdefault(key, []).append((r["token_start"], r["n_tokens"]))
        load.setdefault((r["item_level"], r["container_id"]), []).append(r["n_tokens"])
    assert set(placed) == set(items)
    for key, parts in placed.items():
        parts.sort()
        assert sum(n for _, n in parts) == items[key] and (len(parts) == 1 or items[key] > kinds[key[0]][0])
        assert all(a + n == b for (a, n), (b, _) in zip(parts, parts[1:]))
    assert all(sum(ns) + kinds[lv][1] * (len(ns) - 1) <= kinds[lv][0] for (lv, _), ns in load.items())
    assert items[("scene", "q::0::0")] == 9 and ("scene", "b::1::0") not in items
    totals = {r["item_level"]: r for r in p.p3_containers(spark, d).collect()}
    assert totals["paragraph"]["n_pieces"] == sum(k[0] == "paragraph" for k in items) + 6 and totals["chunk"]["filled"] > 0.8
    assert all(r["least_containers"] <= r["n_containers"] for r in totals.values())


def test_nothing_to_pack(spark, folder):
    d = folder(paragraphs=([], PARAGRAPHS), scenes=([], SCENES), chunks=([], CHUNKS), budgets=(BUDGET, BUDGETS))
    assert p.p3_assignments(spark, d).count() == 0
