import json
import random
from pathlib import Path

import numpy as np
import pytest
import yaml
from files import docx, epub, mobi, nav_points, paragraph
from pyspark.sql import functions as F

from quire import cli
from quire.plans.build import BuildConfig, run_build, write_outputs
from quire.sources import files, sinks


@pytest.fixture(scope="module")
def library(tmp_path_factory):
    root, rng = tmp_path_factory.mktemp("lib"), random.Random(1)
    body = lambda n: "".join(f"<p>{paragraph(rng, 25)}</p>" for _ in range(n))
    (root / "sea").mkdir()
    (root / "out of print").mkdir()
    (root / "__MACOSX").mkdir()
    (root / "sea" / "one.epub").write_bytes(epub({f"c{i}.xhtml": f"<h2>Chapter {i}</h2>{body(6)}<hr/>{body(4)}" for i in range(3)}, "One"))
    kids = [str(i) for i in range(6)]
    parts = {f"{b}/c{i}.html": body(2) for b in (1, 2) for i in range(6)}
    (root / "sea" / "both.epub").write_bytes(epub(parts, "Both", nav_points([("Book One - Red", "1/c0.html", kids), ("Book Two - Blue", "2/c0.html", kids)])))
    (root / "tale.txt").write_text("Chapter One\n\n" + "\n\n".join(paragraph(rng, 30) for _ in range(9)) + "\n\n* * *\n\n" + paragraph(rng, 200), encoding="utf-8")
    (root / "note.docx").write_bytes(docx([("H1", "Note"), (None, paragraph(rng, 20))], "Note"))
    (root / "kindle.mobi").write_bytes(mobi(f"<h1>K</h1>{body(3)}".encode()))
    (root / "page.html").write_text(f"<body><h1>Page</h1>{body(2)}</body>")
    (root / "broken.mobi").write_bytes(b"\0" * 90)
    (root / "out of print" / "old.txt").write_text("old words")
    (root / "__MACOSX" / "x.txt").write_text("no")
    (root / ".hidden.txt").write_text("no")
    (root / "~$lock.docx").write_text("no")
    (root / "cover.jpg").write_text("no")
    return root


CFG = dict(max_seq_len=202, exclude_patterns=("out of*",), oversize_stop_fraction=1.0)


@pytest.fixture(scope="module")
def built(spark, library):
    return run_build(spark, BuildConfig(raw_root=str(library), **CFG))


def test_listing(spark, library):
    got = files.list_files(spark, str(library))
    assert sorted(r["rel"] for r in got.collect()) == ["broken.mobi", "kindle.mobi", "note.docx", "out of print/old.txt", "page.html", "sea/both.epub", "sea/one.epub", "tale.txt"]
    books = {r["book_id"]: r for r in files.discover_books(got).collect()}
    assert books["sea_one"]["series"] == "sea" and books["tale"]["series"] == "_root" and books["broken"]["order_hint"] == 0


def test_build(built):
    s = built.stats
    assert {e["book_id"] for e in s["errors"]} == {"broken"} and s["corpus"]["books_excluded"] == 1 and s["exclusions"]["matched"][0]["matched_pattern"] == "out of*"
    ids = {b["book_id"] for b in s["provenance"]["books"]}
    assert ids == {"kindle", "note", "page", "tale", "sea_one", "sea_both__red", "sea_both__blue"}
    d = s["dataset"]
    assert d["train_chunks"] + d["val_chunks"] == d["chunks"] == built.chunks.count() and d["train_tokens"] + d["val_tokens"] == d["content_tokens"]
    assert d["training_tokens_including_boundaries"] == d["content_tokens"] + 2 * d["chunks"]
    assert sum(b["chunks"] for b in s["provenance"]["books"]) == d["chunks"] and set(s["oversize"]["by_kind"]) >= {"oversize_paragraph"}
    assert built.chunks.groupBy("book_id").agg(F.countDistinct("split").alias("k")).where("k > 1").count() == 0


def test_outputs(spark, built, tmp_path):
    out = write_outputs(BuildConfig(out_root=str(tmp_path), run_name="r", emit_dataset=True, **CFG), built)
    rows = [json.loads(x) for x in (out / "chunks.jsonl").read_text().splitlines()]
    parts = [json.loads(x)["id"] for n in ("train", "val") for x in (out / f"{n}.jsonl").read_text().splitlines()]
    assert sorted(parts) == sorted(r["id"] for r in rows) and [r["id"] for r in rows] == sorted(r["id"] for r in rows)
    assert list(rows[0])[:5] == ["id", "text", "n_tokens", "book_id", "book_title"] and set(rows[0]["flags"]) == {"starts_chapter", "starts_scene", "ends_scene", "continues_scene", "spans_multiple_scenes"}
    assert "# run" in (out / "REPORT.md").read_text() and json.loads((out / "stats.json").read_text())["dataset"]["chunks"] == len(rows)
    assert spark.read.parquet(str(out / "dataset")).count() == len(rows)


def test_token_stream(built, tmp_path):
    vocabulary = "/opt/tokenizers/byte_bpe_50k.tiktoken"
    if not Path(vocabulary).exists():
        pytest.skip("no vocabulary here")
    stream = sinks.pack_stream(built.chunks, vocabulary, 1, 2, 4000)
    made = sinks.export_arrays(stream, str(tmp_path))
    ids, offsets = np.load(tmp_path / "input_ids.npy"), np.load(tmp_path / "offsets.npy")
    assert ids.dtype == np.uint32 and offsets.dtype == np.int64 and len(ids) == made["tokens"] == offsets[-1, 1] and (offsets[1:, 0] == offsets[:-1, 1]).all() and (offsets[:, 1] - offsets[:, 0] == offsets[:, 2]).all()
    seqs = list(sinks.read_packed(str(tmp_path), "train")) + list(sinks.read_packed(str(tmp_path), "val"))
    assert len(seqs) == made["n"] and all(s[0] == 1 and s[-1] == 2 for s in seqs) and len(next(sinks.read_packed(str(tmp_path), "train", 5))) == 5
    with pytest.raises(AssertionError):
        sinks.pack_stream(built.chunks, vocabulary, 1, 2, 10)
    batch = sinks.collate(stream.select("id", "ids").withColumn("batch", F.lit(0)), "batch").collect()
    size = max(len(s) for s in seqs)
    assert {len(r["input_ids"]) for r in batch} == {-(-size // 8) * 8} and all(sum(r["attention_mask"]) == sum(x != -100 for x in r["labels"]) for r in batch)
    assert sinks.find_dataset(str(tmp_path)) == tmp_path and sinks.package(str(tmp_path), str(tmp_path / "p")) == 2


def test_manifest(spark, library, tmp_path):
    m = tmp_path / "m.yaml"
    m.write_text(yaml.safe_dump({"books": [{"id": "mix", "title": "Mix", "sources": ["tale.txt", "note.docx"]}]}))
    r = run_build(spark, BuildConfig(raw_root=str(library), manifest=str(m), max_seq_len=502))
    (book,) = r.books.collect()
    assert book["book_id"] == "mix" and book["title"] == "Mix" and book["source_files"] == ["tale.txt", "note.docx"] and r.stats["dataset"]["val_chunks"] == 0
    for entry, error in (({"id": "x", "sources": ["nope.txt"]}, FileNotFoundError), ({"id": "x"}, ValueError)):
        m.write_text(yaml.safe_dump({"books": [entry]}))
        with pytest.raises(error):
            run_build(spark, BuildConfig(raw_root=str(library), manifest=str(m)))


def test_command_line(spark, library, tmp_path, capsys):
    base = ["--raw-root", str(library), "--out-root", str(tmp_path), "--max-seq-len", "202"]
    assert cli.main([*base, "--oversize-stop-fraction", "0.001"]) == 3 and not (tmp_path / "run").exists()
    assert cli.main([*base, "--dry-run", "--json"]) == 0 and not (tmp_path / "run").exists()
    assert cli.main([*base, "--oversize-stop-fraction", "0.001", "--force"]) == 0 and (tmp_path / "run" / "train.jsonl").exists()
    assert cli.main([*base, "--val-fraction", "2"]) == 2 and cli.main([*base, "--val-books", "nope"]) == 2 and cli.main(["--manifest", str(tmp_path / "no.yaml"), *base]) == 2
    assert cli.main(["--check-tokenizer", "--allow-proxy-tokenizer"]) == 0 and cli.main(["--check-tokenizer", "--tokenizer", "/nope"]) == 2
    bad = tmp_path / "bad.yaml"
    for text in ("a: [1", "- 1\n- 2", "budget: {max_seq_len: [1]}"):
        bad.write_text(text)
        assert cli.main(["--config", str(bad), *base[:4]]) == 2
    for text in ("a: [1", "books: 3", "books: [3]", "books: [{id: a, sources: [tale.txt]}, {id: a, sources: [note.docx]}]"):
        bad.write_text(text)
        assert cli.main(["--manifest", str(bad), *base]) == 2
    assert cli.main(["--raw-root", str(tmp_path / "nowhere")]) == 2
    assert cli.main([*base, "--oversize-stop-fraction", "1", "--part-files", "--run-name", "parts"]) == 0
    parts = sorted((tmp_path / "parts" / "chunks.jsonl").glob("part-*.json"))
    one = cli.main([*base, "--oversize-stop-fraction", "1", "--run-name", "one"])
    assert one == 0 and "".join(p.read_text() for p in parts).count("\n") == (tmp_path / "one" / "chunks.jsonl").read_text().count("\n")
    capsys.readouterr()


def test_no_book_is_lost(spark, tmp_path):
    """Files with one id, a collection whose novels have one title, and a file without prose."""
    rng = random.Random(3)
    (tmp_path / "shelf").mkdir()
    (tmp_path / "shelf" / "Book.txt").write_text("Chapter One\n\nwords of the first")
    (tmp_path / "shelf" / "Book.md").write_text("# Chapter\n\nwords of the second")
    (tmp_path / "shelf" / "empty.txt").write_text("# Only a heading\n")
    kids = [str(i) for i in range(6)]
    parts = {f"{b}/c{i}.html": f"<p>{paragraph(rng, 20)} novel{b}</p>" for b in (1, 2) for i in range(6)}
    (tmp_path / "two.epub").write_bytes(epub(parts, "Two", nav_points([("Book One - Sea", "1/c0.html", kids), ("Book Two - Sea", "2/c0.html", kids)])))
    r = run_build(spark, BuildConfig(raw_root=str(tmp_path), max_seq_len=302, split_by="none"))
    got = {x["book_id"]: x["source_files"] for x in r.books.collect()}
    assert got == {"shelf_book": ["shelf/Book.md"], "shelf_book-2": ["shelf/Book.txt"], "two__sea": ["two.epub"], "two__sea-2": ["two.epub"]}
    text = {}
    for c in r.chunks.orderBy("order_in_book").collect():
        text[c["book_id"]] = text.get(c["book_id"], "") + c["text"]
    assert "second" in text["shelf_book"] and "first" in text["shelf_book-2"] and text["two__sea"].count("novel1") == 6 and text["two__sea-2"].count("novel2") == 6
    assert [(e["book_id"], e["error"]) for e in r.stats["errors"]] == [("shelf_empty", "no paragraphs extracted")]


def test_recipe(tmp_path):
    f = tmp_path / "r.yaml"
    f.write_text(yaml.safe_dump({"run_name": "x", "budget": {"max_seq_len": 512}, "chunking": {"include_chapter_headings": False}, "sources": {"exclude_patterns": ["a*"], "drop_repeated_headings": False}, "splits": {"val_books": ["b"]}, "outputs": {"chunks_jsonl": False}}))
    p = cli.build_parser()
    p.set_defaults(**cli.recipe_defaults(str(f)))
    cfg = cli.config_of(p.parse_args(["--max-seq-len", "256"]))
    assert (cfg.run_name, cfg.max_seq_len, cfg.include_chapter_headings, cfg.exclude_patterns, cfg.drop_repeated_headings, cfg.val_books, cfg.write_chunks) == ("x", 256, False, ("a*",), False, ("b",), False)
    assert len(cli.recipe_keys()) == 23


def test_stream(spark, tmp_path):
    from quire.streaming import ingest

    schema = "doc_id long, text string, source string, fetched_at timestamp"
    spark.sql("select 1L as doc_id, 'one two' as text, 'a' as source, timestamp'2025-01-01 00:00:00' as fetched_at union all select 2L, null, 'a', timestamp'2025-01-01 05:00:00'").write.parquet(str(tmp_path / "in"))
    priced = ingest.price(ingest.read_documents(spark, str(tmp_path / "in"), schema))
    q = ingest.windowed_totals(priced, "fetched_at").writeStream.outputMode("complete").format("memory").queryName("totals").option("checkpointLocation", str(tmp_path / "cp")).start()
    q.processAllAvailable()
    q.stop()
    (row,) = spark.table("totals").collect()
    assert (row["source"], row["n_docs"], row["n_tokens"]) == ("a", 2, 2)


def test_sql_face(spark, built, library):
    from quire.plans import sql

    sql.register(spark)
    spark.read.format("binaryFile").load([str(library / "tale.txt"), str(library / "broken.mobi"), str(library / "note.docx")]).createOrReplaceTempView("raw_files")
    got = spark.sql("select path, b.* from raw_files, lateral extract_blocks(path, content) b").collect()
    assert {r["kind"] for r in got} == {"heading", "paragraph", "scene_break", None} and [r["error"] for r in got if r["error"]][0].startswith("KindleError")
    assert spark.sql("select token_count('one two three four'), token_count(null)").first()[:] == (5, 0)
    assert "chunks" in sql.views(built) and spark.table("chunks").count() == built.stats["dataset"]["chunks"]


def test_example_files():
    root = Path(__file__).resolve().parents[1] / "configs"
    assert cli.recipe_defaults(str(root / "recipe.example.yaml"))["max_seq_len"] == 8192
    assert len(yaml.safe_load((root / "manifest.example.yaml").read_text())["books"]) == 2


def test_optional_unpacker(monkeypatch, tmp_path):
    import sys
    import types

    from quire.sources import kindle

    def extract(path):
        (tmp_path / "x").mkdir(exist_ok=True)
        (tmp_path / "x" / "b.epub").write_bytes(epub({"c.xhtml": "<h2>One</h2><p>some words</p>"}, "Inner"))
        return str(tmp_path / "x"), str(tmp_path / "x" / "b.epub")

    monkeypatch.setitem(sys.modules, "mobi", types.SimpleNamespace(extract=extract))
    (doc,) = kindle.kindle_documents(mobi(b"x", version=8, author="Ann"), "a.azw3", "a")
    assert doc.meta["title"] == "Inner" and doc.meta["author"] == "Ann" and doc.blocks[1][1] == "some words"
