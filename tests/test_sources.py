import pytest
from files import docx, epub, mobi, nav_points

from quire.sources import archives, kindle, markup
from quire.sources.files import extract_documents

H, B, P = "heading", "scene_break", "paragraph"


def blocks(html, **kw):
    return markup.html_blocks(f"<html><head><title>no</title></head><body>{html}</body></html>", **kw)


@pytest.mark.parametrize(
    "html,want",
    [
        ("<h1>One</h1><h4>Sub</h4><p>a <b>b</b>c</p>", [(H, "One", 1), (H, "Sub", 2), (P, "a b c", 0)]),
        ("<p>line one<br/>line two<BR>* * *</p>", [(P, "line one", 0), (P, "line two", 0), (B, "", 0)]),
        ("<p>soft\nwrapped   text</p>", [(P, "soft wrapped text", 0)]),
        ("<hr/><div class='scene-break'></div><div class='three'></div><div class='x'></div>", [(B, "", 0)] * 3),
        ("<p class='sep ornament'>* * *</p><p align='center'>* * *</p>", [(B, "", 0)] * 2),
        ("<p class='chapter-title'>Chapter 1</p><p class='ChapNo'>The Mill</p>", [(H, "Chapter 1", 1), (H, "The Mill", 1)]),
        ("<p align='center'><font size='6'>EMBER</font></p><p class='center'>Short line</p>", [(H, "EMBER", 1), (H, "Short line", 1)]),
        ("<p align='center'>This one ends in a mark.</p>", [(P, "This one ends in a mark.", 0)]),
        ("<div><p>x y</p><div><p>z w</p></div></div>bare text", [(P, "x y", 0), (P, "z w", 0), (P, "bare text", 0)]),
        ("<script>no</script><nav><p>no</p></nav><p>yes<img src='a'></p>", [(P, "yes", 0)]),
        ("<p>one<p>two<ul><li>a1<li>b1</ul>", [(P, "one", 0), (P, "two", 0), (P, "a1", 0), (P, "b1", 0)]),
        ("<table><tr><td>a</td><td>b</td></tr></table>", [(P, "a b", 0)]),
        ("<h2></h2><p> </p>x", []),
        ("<span>inline text</span>", [(P, "inline text", 0)]),
    ],
)
def test_html(html, want):
    assert blocks(html) == want


def test_broken_markup_never_raises():
    for html in ("", "<", "<p", "</p></div>", "<p><b>x", "<!-- c --><p>y", "&nbsp;&#9;&bogus;", "<a" * 500):
        blocks(html)


def test_epub_order_and_nav():
    data = epub({"ch1.xhtml": "<h2>One</h2><p>first text</p>", "cover.xhtml": "<p>no</p>", "ch2.xhtml": "<h2>Two</h2><p>second text</p>"}, nav=True)
    (doc,) = archives.epub_documents(data, "stem")
    assert [b[1] for b in doc.blocks] == ["One", "first text", "Two", "second text"] and doc.meta["title"] == "A Book"
    assert doc.blocks[0][3] == "epub:OPS/ch1.xhtml"


def test_epub_collections():
    text = "<p>some words here</p>"
    isbns = {f"978141699{b:04}_ch{i}.html": text for b in (1, 2) for i in range(3)}
    ncx = nav_points([("Sea of Glass", "9781416990001_ch0.html", ["a", "b"]), ("About the Author", "9781416990002_ch2.html", []), ("Second Sea", "9781416990002_ch0.html", ["a"])])
    assert [d.meta["title"] for d in archives.epub_documents(epub(isbns, ncx=ncx), "s")] == ["Sea of Glass", "Second Sea"]
    parts = {"title.html": text} | {f"{b}/c{i}.html": text for b in (1, 2) for i in range(6)}
    kids = [f"Chapter {i}" for i in range(6)]
    ncx = nav_points([("Book One", "1/c0.html", ["Gold Hill", *kids]), ("Book Two: Far Away", "2/c0.html", kids)])
    docs = archives.epub_documents(epub(parts, ncx=ncx), "s")
    assert [d.meta["title"] for d in docs] == ["Gold Hill", "Far Away"] and [len(d.blocks) for d in docs] == [7, 6]
    plain = nav_points([("Gold", "1/c0.html", kids), ("Silver", "2/c0.html", kids)])
    assert len(archives.epub_documents(epub(parts, ncx=plain), "s")) == 1
    assert len(archives.epub_documents(epub(parts, title="The Boxed Set", ncx=plain), "s")) == 2
    assert len(archives.epub_documents(epub(parts, ncx=ncx), "s", split_omnibus=False)) == 1
    assert archives.part_index(["titlepage.html", "3/titlepage.html"], "3/titlepage.html#x") == 1
    assert archives.part_index(["a/x.html"], "x.html") == 0 and archives.part_index(["a/x.html"], "b/x.html") is None and archives.part_index([], "") is None


def test_docx():
    doc = archives.docx_document(docx([("H1", "The Start"), (None, "plain words"), (None, "* * *"), (None, "Chapter 2"), ("H3", "Sub"), ("Title", "T"), (None, " ")], "My Book."), "s", "a.docx")
    assert [b[:3] for b in doc.blocks] == [(H, "The Start", 1), (P, "plain words", 0), (B, "", 0), (H, "Chapter 2", 1), (H, "Sub", 2), (H, "T", 1)] and doc.meta["title"] == "My Book"


@pytest.mark.parametrize("packed,want", [(b"\x02ab\x80\x08", b"ababa"), (b"\x01a", b"a"), (b"\xc1", b" A"), (b"\x00\x41", b"\x00A"), (b"\x80", b"")])
def test_decompress(packed, want):
    if packed == b"\x02ab\x80\x08":
        packed = b"\x02ab" + bytes([0x80 | (2 << 3 >> 8), (2 << 3 & 0xFF) | 0])
    assert kindle.decompress(packed) == want


def test_overlapping_references():
    ref = lambda d, n: bytes([0x80 | d >> 5, (d << 3 & 0xFF) | n - 3])
    assert kindle.decompress(b"\x02ab" + ref(1, 3)) == b"abbbb" and kindle.decompress(b"\x02XY" + ref(2, 4)) == b"XYXYXY" and kindle.decompress(ref(0, 3)) == b"\0\0\0"
    with pytest.raises(kindle.KindleError):
        kindle.decompress(ref(9, 3))


def test_trailing_data():
    assert kindle.strip_trailing(b"text\x81", 0b10) == b"text" and kindle.strip_trailing(b"text\x00", 0b1) == b"text"
    assert kindle.strip_trailing(b"\x81", 0b10) == b"\x81" and kindle.strip_trailing(b"", 3) == b""
    assert kindle.entry_size(b"abc\x81\x02", 5) == 130 and kindle.entry_size(b"", 0) == 0
    assert kindle.strip_trailing(b"x" * 140 + b"\x81\x02", 0b10) == b"x" * 12
    assert kindle.strip_trailing(b"text\x01ab\x83", 0b11) == b"tex"


def test_kindle():
    html = b"<html><body><h1>One</h1><p>caf\xc3\xa9 text</p><img></body></html>"
    for compression in (1, 2):
        (doc,) = kindle.kindle_documents(mobi(html, compression=compression, author="Ann", trailing=0b10 if compression == 1 else 0), "a.mobi", "a")
        assert [b[1] for b in doc.blocks] == ["One", "café text"] and doc.meta["title"] == "A Kindle Book" and doc.meta["author"] == "Ann"
    (doc,) = kindle.kindle_documents(mobi("<p>œuvre ici</p>".encode("cp1252"), codepage=1252), "a.mobi", "a")
    assert doc.blocks[0][1] == "œuvre ici"
    for bad in (b"", b"\0" * 77, b"\0" * 78, mobi(html, encryption=2), mobi(html, version=8), mobi(html, compression=17480), mobi(html, compression=7)):
        with pytest.raises(kindle.KindleError):
            kindle.kindle_documents(bad, "a.mobi", "a")


def test_kindle_collection():
    def book(title):
        return f"<p>{title}</p><p>Contents</p>".encode() + b"<p>some words</p>" * 4000

    one, two = book("First"), book("Second")
    links = b"<a filepos=%010d>First</a><a filepos=%010d>Second</a>"
    base = len(links % (0, 0))
    raw = links % (base, base + len(one)) + one + two
    docs = kindle.kindle_documents(mobi(raw, "Both"), "a.mobi", "a")
    assert [d.meta["title"] for d in docs] == ["First", "Second"] and docs[1].blocks[0][1] == "Second"
    spans = kindle.book_spans(raw)
    assert b"".join(raw[s.start : s.end] for s in spans) == raw and [s.title for s in spans] == ["First", "Second"]
    assert kindle.book_spans(b"") == [] and kindle.book_spans(raw[: base + 100]) == []
    assert len(kindle.kindle_documents(mobi(raw, "Both"), "a.mobi", "a", split_omnibus=False)) == 1


def test_dispatch():
    assert extract_documents("x/a.txt", "é\n".encode("cp1252"))[0].blocks[0][1] == "é"
    assert extract_documents("a.HTML", b"<p>one two</p>")[0].meta["title"] == "a"
    for name in ("a.pdf", "a.xyz", "a"):
        with pytest.raises(ValueError):
            extract_documents(name, b"")
