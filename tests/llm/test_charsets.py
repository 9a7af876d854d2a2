from types import SimpleNamespace

import pytest

from quire.llm import charsets as c

SENTENCES = [
    "Le château de Renée était fermé près du vieux pont", "La forêt brûlait déjà après la fête", "El niño olvidó la lección según el capitán", "Der Fährmann öffnete die Tür für das Mädchen über der Straße",
    "Córka kowala zgubiła czapkę w łąkach każdą wiosnę", "Девочка из деревни слушала реку во время грозы", "“Quiet,” said Göran — and Brøder waited…", "The price had been £4, then €5 for ½ of it",
    "The sign read 灯の港 and ΦΩΣ ΚΑΙ ΑΛΣ", "plain words only",
]
SCHEMA = "book_id string, block_ord long, text string, extra string, restored string"


def garble(t, read, written="utf-8"):
    return t.encode(written).decode(read)


BAD = [
    (garble("Le château de Renée était fermé", "latin-1"), "Le château de Renée était fermé"),
    (garble("La forêt brûlait déjà après la fête", "cp1252").replace("\xa0", "\xa0"), "La forêt brûlait déjà après la fête"),
    (garble("Der Fährmann öffnete die Tür", "mac_roman"), "Der Fährmann öffnete die Tür"),
    (garble("El niño olvidó la lección", "cp437"), "El niño olvidó la lección"),
    (garble("Der Fährmann öffnete die Tür", "cp437", "cp1252"), "Der Fährmann öffnete die Tür"),
    (garble("Девочка из деревни слушала реку", "cp1252", "cp1251"), "Девочка из деревни слушала реку"),
    (garble(garble("Le château était fermé", "cp1252"), "cp1252"), "Le château était fermé"),
    (garble("“Quiet”", "latin-1"), "“Quiet”"),
]


@pytest.fixture(scope="module")
def blocks(spark):
    rows = [(f"b{b}", i, s, "x", "y") for b in range(12) for i, s in enumerate(SENTENCES)]
    rows += [("bad", i, t, "x", "y") for i, (t, _) in enumerate(BAD)]
    rows += [("odd", 0, None, None, None), ("odd", 1, "", None, None), ("odd", 2, "ch�teau", "x", "y"), (None, 3, "plain", None, None), ("odd", 4, "a" * 50_000, None, None), ("bad", 0, BAD[0][0], "x", "y")]
    return spark.createDataFrame(rows, SCHEMA)


def test_found_and_restored(blocks):
    got = {(r["book_id"], r["block_ord"]): r for r in c.garbled(blocks).collect()}
    assert set(got) == {("bad", i) for i in range(len(BAD))} | {("odd", 2)}
    right = sum(got[("bad", i)]["restored"] == t for i, (_, t) in enumerate(BAD))
    assert right >= len(BAD) - 1, [(got[("bad", i)]["restored"], t) for i, (_, t) in enumerate(BAD)]
    assert not got[("odd", 2)]["restorable"] and got[("bad", 0)]["extra"] == "x" and got[("bad", 0)]["restorable"]


def test_query_and_empty_table(spark, blocks, tmp_path):
    blocks.write.parquet(str(tmp_path / "blocks.parquet"))
    spark.createDataFrame([("bad", 65001), ("bad", None)], "book_id string, text_encoding int").write.parquet(str(tmp_path / "mobi_headers.parquet"))
    assert c.p2_found(spark, str(tmp_path)).count() == len(BAD) + 1
    assert {r["declared"] for r in c.p2_restored(spark, str(tmp_path)).where("book_id = 'bad'").collect()} == {65001}
    assert c.garbled(blocks.limit(0)).count() == 0


def test_words():
    assert c.suspicious("plain “quoted” words…") == [] and set(c.suspicious("Göran &#226;x y")) == {"Göran", "&#226;x"}
    forms = dict((f, n) for n, f in c.candidates("Ã©tÃ©", 0))
    assert "été" in forms
    assert "à" in {f for _, f in c.candidates("Ã", 1)}


def test_lost_bytes_take_the_likeliest_way():
    """The way through the model is that of trying every filling."""
    from itertools import product

    score = lambda w: sum(step(f"\x02\x02{w}"[i : i + 3]) for i in range(len(w)))
    step = lambda three: -((ord(three[2]) * 7 + ord(three[1]) * 3 + ord(three[0])) % 11)
    word = "\u00c3x\u00c3y\u00c3"  # each mark lost the byte behind it
    fills = [bytes([0xC3, b]).decode() for b in sorted({*c._lost()["latin-1"], 0xA0}) if 0x80 <= b <= 0xBF]
    best = max(score("".join(p)) for p in ((a, "x", b, "y", d) for a, b, d in product(fills, fills, fills)))
    assert abs(max(map(score, c._wide(word, "latin-1", True, SimpleNamespace(step=step, saw=lambda g: True)))) - best) < 1e-9


def test_endless_words_are_cut_between_characters():
    word = "\u00c3\u00a9" * 400 + "z"
    parts = c.pieces_of(word)
    assert "".join(parts) == word and all(len(p) <= 2 * c.PIECE and p[0] != "\u00a9" for p in parts)


def test_garbled_words_are_recovered(blocks):
    model = c.train(blocks)
    assert model.recovered >= 0.6 and model.margin >= c.MARGIN


def test_margin_regards_the_books_of_every_part(spark):
    """Headings in capitals stand in the books of one part only; a model without them takes them for garbled."""
    books = spark.range(200).selectExpr("concat('b', id) book").selectExpr("book", f"pmod(xxhash64(book), {c.HELD}) part").collect()
    rows = [(r["book"], i, s, "x", "y") for part in range(c.HELD) for r in [x for x in books if x["part"] == part][:4] for i, s in enumerate(SENTENCES)]
    loud = "LÖCHRIGE ÖFFNETE ÜBER MÜNZEN MÜHLE MÜDER SCHRÄGE SÜSSE GRÜSSTE WÄHREND BLÜTEN HÜTETE FÜRCHTETE FRÜHJAHR BRÜCKE LÖSCHTE VÖLLIGER".split()
    for part in range(c.HELD):
        got = rows + [(r["book"], 99, " ".join(loud), "x", "y") for r in [x for x in books if x["part"] == part][:4]]
        model = c.train(spark.createDataFrame(got, SCHEMA))
        assert model.margin > c.MARGIN + 1, (part, model.margin)


def test_margin_is_the_gain_that_two_in_a_thousand_exceed():
    model = c.CharModel(*c.np.zeros((4, c.SLOTS), c.np.float32))
    model.validate(c.Counter({0.0: 2990, 5.0: 4, 6.5: 4, 9.0: 2}), c.Counter({20.0: 6, 6.0: 2, -1.0: 2}))
    assert model.margin == 5.5 and model.recovered == 0.8
    model.validate(c.Counter({0.0: 10, 8.0: 1}), c.Counter())
    assert model.margin == c.MARGIN and model.recovered == 1.0
