import math

import pytest

from quire.llm import scans as s

BLOCKS = "book_id string, block_ord long, kind string, text string"
PARAS = "book_id string, paragraph_index int, text string"
BOOKS = "book_id string, title string, author string"
CLEAN = [
    "The old lantern stood near the harbor and nobody had thought of it since the winter.", "She had never promised the treaty to anybody but her brother in the village.", "The salt-stained door was open, and the four- and six-masted boats lay still.",
    "He laughed at the merchant; then they walked together through the garden.", "What was left of the bridge had been painted green last summer.",
]
DAMAGED = {
    "word": "The old lan-\ntern stood near the harbor and nobody had\nthought of it.", "soft": "She had never prom\xad\nised the treaty.", "misread": "The o1d lantern stood near tbe harbor and nobody had thougbt of it.", "stray": "The old lantern | stood near the harbor.",
    "folio": "— 45 —", "head": "THE QUIET SEA  45", "head2": "Ann Lee · 12", "inside": "The old lantern stood near\nTHE QUIET SEA 46\nthe harbor and nobody had thought of it.", "roman": "The old lantern stood near\nxii\nthe harbor.",
}
FINE = {
    "wrap": "The old lantern stood near\nthe harbor and nobody had\nthought of it since the winter.", "compound": "The salt-\nstained door was open.", "suspended": "The four-\nand six-masted boats lay still.", "slip": "The old lantern stood naer the habror.",
    "null": None, "empty": "", "blank": " \n ", "price": "The price had been £4, then €5.", "long": "She laughed. " * 20_000, "accent": "Göran promised — “never” — the treaty…",
}


@pytest.fixture(scope="module")
def tables(spark, folder):
    rows = [(f"b{b}", i, "paragraph", t) for b in range(8) for i, t in enumerate(CLEAN * 4)]
    rows += [("scan", 10 * i, "paragraph", t) for i, t in enumerate(DAMAGED.values())] + [("fine", 10 * i, "paragraph", t) for i, t in enumerate(FINE.values())]
    rows += [("scan", 0, "paragraph", DAMAGED["word"]), ("fine", 900, "heading", "THE QUIET SEA 45"), ("fine", 901, "scene_break", None), (None, None, "paragraph", "The old lantern stood.")]
    rows += [("cut", 1, "paragraph", "He laughed at the merchant; then they"), ("cut", 2, "paragraph", "[17]"), ("cut", 3, "paragraph", "walked together through the garden."), ("cut", 4, "paragraph", "The bridge had been painted green."), ("cut", 600, "paragraph", "She had never promised the"), ("cut", 602, "paragraph", "treaty to anybody.")]
    rows += [("edge", s.RANGE - 1, "paragraph", "She had never promised the"), ("edge", s.RANGE, "paragraph", "treaty to anybody."), ("ends", 5, "paragraph", "She had never promised the"), ("ends", 6, "heading", "Two"), ("ends", 7, "paragraph", "The old lantern stood.")]
    paras = [("p", 0, "The old lan- tern stood near the harbor."), ("p", 1, "The old lantern stood near THE QUIET SEA 47 the harbor."), ("p", 2, CLEAN[0]), ("p", 3, None), ("p", 4, "She had never promised the"), ("p", 5, "treaty to anybody.")]
    return folder(blocks=(rows, BLOCKS), paragraphs=(paras, PARAS), book_specs=([("scan", "The Quiet Sea", "Ann Lee"), ("p", "The Quiet Sea", None), ("p", "The Quiet Sea", None), (None, "x", None)], BOOKS))


def test_found(spark, tables):
    got = {tuple(r) for r in s.p4_found(spark, tables).collect()}
    want = {("blocks", "scan", 10 * i) for i in range(len(DAMAGED))}
    want |= {("blocks", "cut", o) for o in (1, 2, 3, 600, 602)} | {("blocks", "edge", s.RANGE - 1), ("blocks", "edge", s.RANGE)} | {("paragraphs", "p", o) for o in (0, 1, 4, 5)}
    assert got == want, (got - want, want - got)


def test_repaired(spark, tables):
    got = {(r["rec_table"], r["book_id"], r["rec_ord"]): r["repaired"] for r in s.p4_repaired(spark, tables).collect()}
    at = {k: got[("blocks", "scan", 10 * i)] for i, k in enumerate(DAMAGED)}
    full = "The old lantern stood near the harbor and nobody had thought of it."
    assert at["word"] == at["misread"] == at["inside"] == full and at["soft"] == "She had never promised the treaty." and at["stray"] == "The old lantern stood near the harbor." and at["folio"] == at["head"] == ""
    assert got[("blocks", "cut", 1)] == "He laughed at the merchant; then they walked together through the garden." and got[("blocks", "cut", 3)] == ""
    assert got[("blocks", "edge", s.RANGE - 1)] == "She had never promised the treaty to anybody." and got[("paragraphs", "p", 1)] == "The old lantern stood near the harbor."


def test_empty(spark, folder):
    d = folder(blocks=([], BLOCKS), paragraphs=([], PARAS), book_specs=([], BOOKS))
    assert s.p4_found(spark, d).count() == 0


def test_titles_in_a_join(spark, tables, monkeypatch):
    want = {tuple(r) for r in s.p4_found(spark, tables).collect()}
    monkeypatch.setattr(s, "TITLES", 0)
    assert {tuple(r) for r in s.p4_found(spark, tables).collect()} == want


def test_chain_of_cut_paragraphs(spark, folder):
    parts = ["She had never promised the", "treaty to anybody but her", "brother in the vil-", "lage near the harbor."]
    rows = [(b, at + i, "paragraph", p) for b, at in (("chain", 10), ("range", s.RANGE - 2), ("range", 3000)) for i, p in enumerate(parts)]
    rows += [("long", i, "paragraph", f"and then they walked {i}x on" if i else "And so they went on") for i in range(2 * s.RANGE + 9)] + [("long", 2 * s.RANGE + 9, "paragraph", "to the harbor.")]
    rows += [(f"b{b}", i, "paragraph", t) for b in range(8) for i, t in enumerate(CLEAN * 4)]
    d = folder(blocks=(rows, BLOCKS), paragraphs=([], PARAS), book_specs=([], BOOKS))
    got = {(r["book_id"], r["rec_ord"]): r["repaired"] for r in s.p4_repaired(spark, d).collect()}
    for b, at in (("chain", 10), ("range", s.RANGE - 2), ("range", 3000)):
        assert [got[b, at + i] for i in range(4)] == ["She had never promised the treaty to anybody but her brother in the village near the harbor.", "", "", ""]
    whole = got["long", 0].split()
    assert [w for w in whole if w.endswith("x")] == [f"{i}x" for i in range(1, 2 * s.RANGE + 9)] and whole[-1] == "harbor."
    assert all(not t for (b, i), t in got.items() if b == "long" and i)


def test_all_page_numbers_and_heads_in_a_text():
    reader = s.Reader({w: 1000 for w in "the old lantern stood near harbor and nobody had thought of it since winter".split()}, 14_000)
    want = "the old lantern stood near the harbor and nobody had thought of it since the winter"
    for head in ("12", "xii", "THE QUIET WINTER SEA", "THE QUIET SEA 46"):
        text = want.replace("stood", f"stood {head}").replace("nobody", f"nobody {head}").replace("since", f"since {head}")
        assert reader.judge(text, ()) == (["head"], want, False), head
    text = want.replace("stood", "stood The Quiet Sea 12").replace("nobody", "nobody The Quiet Sea")
    assert reader.judge(text, ("the quiet sea",)) == (["head"], want, False)


LEXICON = {w: 1000 for w in "the old lantern stood near harbor and nobody had thought of it since winter they walked together into garden was open".split()} | {"the": 60_000, "of": 30_000, "and": 20_000, "in": 5_000, "to": 5_000}


def test_splits_merges_and_joint_repairs():
    reader = s.Reader(dict(LEXICON), sum(LEXICON.values()))
    want = "they walked together into the garden near the harbor"
    for text, kinds in (
        ("they walkedtogether into the garden near the harbor", ["split"]), ("they walked toge ther into the garden near theharbor", ["split"]), ("they walked together intothegarden near the harbor", ["split"]),
        ("they walked toge- tber into the garden near the harbor", ["hyphen"]), ("they wa1ked tog ether into tbe garden near the har- bor", ["hyphen", "misread", "split"]), ("they walked together into the gar- 12 den near | the harbor", ["head", "hyphen", "stray"]),
    ):
        assert reader.judge(text, ()) == (kinds, want, False), text
    for text in (want, "Theharbor of Walkedtogether was open", "the unheard zufava stood near the harbor", "it was in to the garden", "harbor lantern winter"):
        assert reader.judge(text, ()) == ([], text, False)


def test_names_with_two_confusions():
    reader = s.Reader({**LEXICON, "marlene": 900}, sum(LEXICON.values()) + 900)
    assert reader.judge("the garden of Marlcnc was open", ())[1] == "the garden of Marlene was open"


def test_boundaries_are_the_cheapest(rng):
    def cost(links, starts):
        sizes, total = [links[0][1], *(x[3] for x in links)], 0.0
        for k, (tail, _, head, _) in enumerate(links):
            total += (0.0 if head == "small" else s.CAPITAL) if starts[k] == starts[k + 1] else s.BREAKS[tail]
        for i in set(starts):
            total += max(0.0, math.log((sum(n for n, of in zip(sizes, starts) if of == i) + 1) / s.LONG))
        return total

    for _ in range(60):
        n = rng.randint(1, 7)
        sizes = [rng.choice([40, 900, 4000, 90_000]) for _ in range(n + 1)]
        links = [(rng.choice(list(s.BREAKS)), sizes[i], rng.choice(["small", "other"]), sizes[i + 1]) for i in range(n)]
        every = []
        for bits in range(2**n):
            starts = [0]
            for i in range(n):
                starts.append(i + 1 if bits >> i & 1 else starts[-1])
            every.append(cost(links, starts))
        assert abs(cost(links, s.boundaries(links)) - min(every)) < 1e-6


def test_every_part_stands_in_one_paragraph(spark, folder, rng):
    """Each kept word stands in exactly one repaired paragraph, wherever pages end."""
    vocabulary = [w for w in " ".join(CLEAN).split() if w.isalpha()]
    rows, words = [], {}
    for b in range(6):
        at = rng.randint(0, 40)
        for k in range(rng.randint(200, 300)):
            text = f"She {' '.join(rng.choice(vocabulary).lower() for _ in range(rng.randint(3, 12)))} w{chr(97 + b)}{'abcdefghij'[k % 10] * (1 + k // 10)}x" if rng.random() < 0.4 else f"{' '.join(rng.choice(vocabulary).lower() for _ in range(rng.randint(3, 12)))} of it."
            rows.append((f"c{b}", at, "paragraph", text))
            words[f"c{b}", at] = text.split()
            at += rng.choice([1, 1, 2, 9])
    rows += [(f"b{b}", i, "paragraph", t) for b in range(8) for i, t in enumerate(CLEAN * 4)]
    d = folder(blocks=(rows, BLOCKS), paragraphs=([], PARAS), book_specs=([], BOOKS))
    got = s.p4_repaired(spark, d).collect()
    assert {tuple(r["damage"]) for r in got} == {("cut",)}, [r for r in got if r["damage"] != ["cut"]][:5]
    assert sorted(w for r in got if "cut" in r["damage"] for w in r["repaired"].split()) == sorted(w for r in got if "cut" in r["damage"] for w in words[r["book_id"], r["rec_ord"]])
    assert len({(r["book_id"], r["rec_ord"]) for r in got}) == len(got) > 300


def test_ends_far_apart_over_a_range(spark, folder):
    rows = [("far", s.RANGE - 4, "paragraph", "She had never promised the"), ("far", s.RANGE + 8, "paragraph", "treaty to anybody."), ("far", 9 * s.RANGE, "paragraph", "He laughed at the merchant and")]
    rows += [("far", 20 * s.RANGE, "paragraph", "walked through the garden."), ("far", 20 * s.RANGE + 1, "heading", "Two")] + [(f"b{b}", i, "paragraph", t) for b in range(8) for i, t in enumerate(CLEAN * 4)]
    d = folder(blocks=(rows, BLOCKS), paragraphs=([], PARAS), book_specs=([], BOOKS))
    got = {r["rec_ord"]: r["repaired"] for r in s.p4_repaired(spark, d).collect()}
    assert got == {s.RANGE - 4: "She had never promised the treaty to anybody.", s.RANGE + 8: "", 9 * s.RANGE: "He laughed at the merchant and walked through the garden.", 20 * s.RANGE: ""}


def test_capitals_are_judged_over_the_whole_text():
    start = "THE OLD LANTERN STOOD NEAR THE HARBOR AND NOBODY HAD THOUGHT OF IT. " * 5
    assert s.is_shouted(start) and not s.is_shouted(start + start.lower() * 2)
    assert s.is_shouted(start.lower() + start * 2)


def test_words_beyond_the_lexicon_count(spark, tables, monkeypatch):
    found, repaired = ({tuple(map(str, r)) for r in q(spark, tables).collect()} for q in (s.p4_found, s.p4_repaired))
    monkeypatch.setattr(s, "LEXICON", 12)
    assert {tuple(map(str, r)) for r in s.p4_found(spark, tables).collect()} == found
    assert {tuple(map(str, r)) for r in s.p4_repaired(spark, tables).collect()} == repaired
