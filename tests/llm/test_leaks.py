from tables import WORDS

from quire.llm import leaks as k

ITEMS = "item_id long, suite string, passage string, question string, answer string"


def words(rng, n):
    return [rng.choice(WORDS) + str(rng.randint(0, 40)) for _ in range(n)]


def test_wand_equals_exhaustive_scores(rng):
    passages = [words(rng, rng.randint(1, 60)) for _ in range(80)] + [["a", "b"]]
    index = k.ItemIndex(passages)
    for _ in range(40):
        doc = words(rng, 50) + rng.choice(passages)[: rng.randint(0, 60)] + rng.choice(passages)
        terms = {t for size in (k.TERM, *index.sizes) for t in k.terms_of(doc, size)}
        scores = [0.0] * len(passages)
        for t in terms:
            if t in index.lists:
                for d, x in zip(*index.lists[t][:2]):
                    scores[d] += x
        for threshold in (0.01, 0.2, 0.7):
            assert index.query(terms, threshold) == [d for d, s in enumerate(scores) if s >= threshold - 1e-12]


def test_found(spark, folder, rng):
    p = [words(rng, 60) for _ in range(4)]
    noise = lambda n: " ".join(words(rng, n))
    two = " ".join(p[1][:15]) + " " + noise(30) + " " + " ".join(p[1][40:55])
    changed = " ".join("changed" if i % 14 == 7 else w for i, w in enumerate(p[2]))
    shuffled = p[3][:]
    rng.shuffle(shuffled)
    docs = [
        (1, noise(100) + " " + " ".join(p[0]).upper() + " " + noise(50)), (2, two), (3, "<p>" + changed.replace(" ", " <b>x</b>", 0) + "</p>"), (4, " ".join(shuffled)), (5, " ".join(p[0][:20]) + " " + noise(40)), (6, None), (7, ""), (8, "…"),
        (9, " ".join(p[0][:30]).replace(" ", ", ")), (1, noise(3)), (10, "is it true and why " + noise(50)), (11, noise(20_000) + " ".join(p[3])),
    ]
    items = [(i, "s", " ".join(w), "is it true and why", w[0]) for i, w in enumerate(p)] + [(100, "s", " ".join(p[0]), None, None), (101, "s", None, "q", "a"), (102, "s", "", None, None), (0, "s", " ".join(p[0]), "is it true and why", p[0][0])]
    d = folder(documents=(docs, "doc_id long, text string"), heldout_items=(items, ITEMS))
    assert sorted(map(tuple, k.p8_found(spark, d).collect())) == [(1, 0), (1, 100), (2, 1), (3, 2), (9, 0), (9, 100), (11, 3)]
    leaks = {(r["doc_id"], r["item_id"]): r for r in k.p8_leaks(spark, d).collect()}
    assert leaks[(1, 0)]["share"] == 1.0 and {r["kind"] for r in leaks.values()} == {"passage"}  # the answer inside the passage is no second leak
    n = {r["item_id"]: r["n_docs"] for r in k.p8_items(spark, d).collect()}
    assert n[0] == 2 and n[101] == 0


def test_kinds_of_leaks(spark, rng):
    p, far = words(rng, 50), " ".join(words(rng, 300))
    question, answer = "what did the keeper hide beneath the old lantern", "copper letter"
    noise = " ".join(words(rng, 20))
    texts = {
        "passage": " ".join(p), "passage+question": f"{' '.join(p)} {noise} What did the keeper hide, beneath the lantern?", "passage+answer": f"Copper letter. {noise} {' '.join(p)}",
        "passage+question+answer": f"{question}? {noise} {' '.join(p[:25])} {noise} copper letter {' '.join(p[25:])}",
    }
    docs = [(i, t) for i, t in enumerate(texts.values())] + [(9, f"{' '.join(p)} {far} {question} {answer}"), (10, f"{' '.join(p)} letter copper lantern old the beneath hide keeper the did what")]
    items = spark.createDataFrame([(1, "s", " ".join(p), question, answer)], ITEMS)
    got = {r["doc_id"]: r["kind"] for r in k.find_leaks(spark.createDataFrame(docs, "doc_id long, text string"), items).collect()}
    assert got == dict(enumerate(texts)) | {9: "passage", 10: "passage"}


def test_copies_with_changed_words(rng):
    """Found with a changed word in every sixth or more; two parts of a short passage; not: phrases of five words."""
    def share(passage, doc):
        at = {}
        for j, t in enumerate(k.terms_of(doc)):
            at.setdefault(t, []).append(j)
        return k.overlap(passage, doc, at)[0]

    for n in (30, 60, 200):
        p = words(rng, n)
        for every in (6, 7, 10):
            assert share(p, words(rng, 9) + [f"x{i}" if i % every == 5 else w for i, w in enumerate(p)]) >= 0.7, (n, every)
        assert share(p, words(rng, 50)) == 0 and share(p, words(rng, 9) + p[: int(0.6 * n)]) >= 0.59
    p = words(rng, 40)
    assert share(p, p[:9] + words(rng, 20) + p[25:34]) >= 0.44 and share(p, p[:5] + words(rng, 9) + p[20:25] + words(rng, 9) + p[30:35]) == 0


def test_blocks_of_items_and_empty_tables(spark, rng, monkeypatch):
    monkeypatch.setattr(k, "ITEM_BLOCK", 2)
    p = [words(rng, 40) for _ in range(5)]
    docs = spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(p)], "doc_id long, text string")
    items = spark.createDataFrame([(i, "s", " ".join(w), None, None) for i, w in enumerate(p)], ITEMS)
    assert k.find_leaks(docs, items).count() == 5
    assert k.find_leaks(docs.limit(0), items).count() == 0 and k.find_leaks(docs, items.limit(0)).count() == 0
