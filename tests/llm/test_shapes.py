import pytest

from quire.llm import shapes as s

PROSE = "The ferry left before dawn, and nobody on the pier had slept. She counted the lanterns twice; there were nine of them, and one was out."
SPAM = [
    "buy cheap lamps lamps sale lamps best lamps review lamps cheap lamp sale best lamp deal lamps online lamps lamp free lamps " * 4,
    "#lamps #lampsale #lampsonline #lamps #bestlamps #lamps #lampsale #lamps #lights",
    "\n".join(f"Lamp {i} - https://shop{i}.example/lamp_{i}?ref={i}" for i in range(12)),
    "\n".join(f"- [Lamp {i}](https://a.example/x{i})" for i in range(9)),
    " | ".join(f'<a href="https://a.example/{i}">lamps</a>' for i in range(9)),
    "www.a.example/x\nshop.b.example/y\nm.c.example/z/\n" * 3,
    "Home » Lamps » Brass » The Old Lamp »\nHome » Lamps » Tin » The New Lamp »\n" * 4,
    " | ".join(f"The Lamp and the Door Hardcover £{i}.49 SKU {i}00" for i in range(10, 20)),
    "Tags: lamp, old lamp, brass, the tin lamp, light, window, evening, lantern, harbor, quiet",
    "la lampe online, la lampe gratis, la lampe pdf, la lampe barato, la lampe kaufen, la lampe online, la lampe pdf, la lampe gratis",
]
FINE = [
    PROSE, None, "", "  \n ", "?", "Contents\n\n" + "\n".join(f"{i}. The Lamp and the {w} ........ {i * 9}" for i, w in enumerate("Door Sea Hill Mill Road Ship".split(), 1)),
    "The people of this book\n\n" + "\n".join(f"Ann {w}, the quiet keeper who mended the lamp" for w in "Lee Moor Sand Hill".split()),
    "Glossary\n\n" + "\n".join(f"{w}: a small lamp, kept beside the door in winter." for w in "abal tuko rime salo".split()),
    "\n".join(["The lamp went over the hill,", "And the old dog slept, oh, slept,", "All night the river was still,", "And the old dog slept, oh, slept,"] * 4),
    "“Where is it?” she asked.\n“Gone,” he said.\n“Who took it?”\n“Nobody knows, and nobody will say.”",
    "Books I read\n\n" + "\n".join(f"The Lamp {i} (https://a.example/{i}). {PROSE}" for i in range(4)),
    f"{PROSE} See https://a.example/x for the map. {PROSE}", "def f(x):\n    return [x, x + 1]\n\nfor i in range(9):\n    print(f(i), end=', ')\n", "12 99 3 4711 5 6 77 8 912 33 1 " * 9, ".,;:!?" * 50,
    "הלך הילד אל הים ולא חזר עד הערב " * 3, "灯の港は静かだった。" * 9, "Stary latarnik słuchał rzeki mimo chłodu, od powodzi. Babcia otworzyła skrzynię za młynem. Książę zgubił czapkę podczas burzy.",
]


TABLE = "doc_id long, text string, share string"


@pytest.fixture(scope="module")
def shares(spark):
    """Share of words in list shapes of SPAM, of SPAM among sentences, of FINE, and of FINE with one link behind it."""
    mixed = ["\n".join([PROSE, *[t] * 4]) for t in SPAM]
    linked = [f"{t}\nhttps://a.example/about" if t and len(s.Units([t]).n) and s.Units([t]).n.sum() > 15 else t for t in FINE]
    texts = SPAM + mixed + FINE + linked
    got = {r["doc_id"]: r for r in s.judged(spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], TABLE)).collect()}
    rows = iter([got[i] for i in range(len(texts))])
    return {name: [next(rows) for _ in of] for name, of in (("spam", SPAM), ("mixed", mixed), ("fine", FINE), ("linked", linked))}


def test_spam_is_flagged(shares):
    for name in ("spam", "mixed"):
        assert [i for i, r in enumerate(shares[name]) if r["share"] <= s.SHARE] == []
    assert all(r["kind"] and r["shapes"] for r in shares["spam"])


def test_fine_is_not_and_a_link_changes_nothing(shares):
    for name in ("fine", "linked"):
        assert [i for i, r in enumerate(shares[name]) if r["share"] > s.SHARE] == []


def test_verdict_does_not_hang_on_a_link(spark):
    """Lists of many words among sentences of fewer: with and without a harmless line the page is flagged."""
    lists = "\n".join("bright lamp, old lamp, tin lamp, brass lamp, red lamp, best lamp, cheap lamp, new lamp, blue lamp, top lamp, big lamp, low lamp" for _ in range(12))
    page = f"{lists}\n" + "\n".join([PROSE] * 8)
    rows = [(1, page, "x"), (2, page + "\nSee www.a.example/x for more.", "x")]
    assert sorted(r["doc_id"] for r in s.flagged(spark.createDataFrame(rows, TABLE)).collect()) == [1, 2]


def test_measures_of_units():
    u = s.Units(["One two. Three, four", "", "www.a.example/x and\n#a #b #c"])
    kept = u.weight() > 0
    assert u.page[kept].tolist() == [0, 0, 2, 2] and u.n[kept].tolist() == [2, 2, 1, 3]
    assert u.links[kept].tolist() == [0, 0, 1, 0] and u.tags[kept].tolist() == [0, 0, 0, 3] and u.ends[kept].tolist() == [True, False, False, False] and u.items[kept].tolist() == [1, 2, 1, 1]


def test_batches_do_not_change_shapes(rng):
    texts = SPAM + [t for t in FINE if t] + [PROSE * 40]
    def table(most):
        out = []
        for a, b in s.slices(texts, most):
            page, code, weight, _ = s.shapes_of(texts[a:b])
            out += sorted(zip((page + a).tolist(), code.tolist(), weight.tolist()))
        return out
    assert table(1) == table(10**9) and len(table(1)) > 100


def test_long_text_and_query(spark, folder):
    assert s.shapes_of([PROSE * 3000])[2].sum() == 3000 * 26
    rows = [(i, t, "x") for i, t in enumerate(SPAM + FINE)] + [(0, SPAM[0], "x")]
    d = folder(documents=(rows, TABLE))
    assert sorted(r["doc_id"] for r in s.p9_found(spark, d).collect()) == list(range(len(SPAM)))
    assert sum(r["n_pages"] for r in s.p9_shapes(spark, d).collect()) == len(SPAM) + 1
    assert s.p9_found(spark, folder(documents=([], "doc_id long, text string"))).count() == 0
