"""Invented manuscripts in every format, and a demonstration library of them."""

from __future__ import annotations

import io
import random
import struct
import zipfile

WORDS = "harbor lantern quiet orchard winter copper letter bridge morning shadow garden river engine violet window story".split()


def paragraph(rng: random.Random, n: int) -> str:
    return " ".join(rng.choice(WORDS) for _ in range(n)).capitalize() + "."


def epub(parts: dict[str, str], title: str = "A Book", ncx: str = "", description: str = "", nav: bool = False) -> bytes:
    out = io.BytesIO()
    items = "".join(f'<item id="i{i}" href="{n}" media-type="application/xhtml+xml"/>' for i, n in enumerate(parts))
    items += '<item id="nav" href="nav.xhtml" media-type="application/xhtml+xml" properties="nav"/>' if nav else ""
    refs = ("<itemref idref=\"nav\"/>" if nav else "") + "".join(f'<itemref idref="i{i}"/>' for i in range(len(parts)))
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("mimetype", "application/epub+zip")
        z.writestr("META-INF/container.xml", '<container><rootfiles><rootfile full-path="OPS/content.opf"/></rootfiles></container>')
        z.writestr("OPS/content.opf", f"<package><metadata><dc:title>{title}</dc:title><dc:description>{description}</dc:description></metadata><manifest>{items}</manifest><spine>{refs}</spine></package>")
        for n, body in parts.items():
            z.writestr(f"OPS/{n}", f"<html><head><title>x</title></head><body>{body}</body></html>")
        if nav:
            z.writestr("OPS/nav.xhtml", "")
        if ncx:
            z.writestr("OPS/toc.ncx", ncx)
    return out.getvalue()


def nav_points(points: list[tuple[str, str, list[str]]]) -> str:
    inner = "".join(
        f"<navPoint><navLabel><text>{label}</text></navLabel><content src='{src}'/>" + "".join(f"<navPoint><navLabel><text>{k}</text></navLabel></navPoint>" for k in kids) + "</navPoint>" for label, src, kids in points
    )
    return f"<ncx><docTitle><text>Set</text></docTitle><navMap>{inner}</navMap></ncx>"


def docx(paras: list[tuple[str | None, str]], title: str = "") -> bytes:
    out = io.BytesIO()
    body = "".join(f"<w:p>{f'<w:pPr><w:pStyle w:val={chr(34)}{s}{chr(34)}/></w:pPr>' if s else ''}<w:r><w:t>{t}</w:t></w:r></w:p>" for s, t in paras)
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("word/document.xml", f"<w:document><w:body>{body}<w:tbl><w:tr><w:tc><w:p><w:r><w:t>cell</w:t></w:r></w:p></w:tc></w:tr></w:tbl></w:body></w:document>")
        z.writestr("word/styles.xml", "<w:styles><w:style w:styleId='H1'><w:name w:val='heading 1'/></w:style><w:style w:styleId='H3'><w:name w:val='heading 3'/></w:style></w:styles>")
        z.writestr("docProps/core.xml", f"<cp:coreProperties><dc:title>{title}</dc:title></cp:coreProperties>")
    return out.getvalue()


def mobi(text: bytes, name: str = "A Kindle Book", compression: int = 1, encryption: int = 0, version: int = 6, author: str = "", codepage: int = 65001, trailing: int = 0) -> bytes:
    size = 4096
    chunks = [text[i : i + size] for i in range(0, len(text), size)] or [b""]
    if compression == 2:
        chunks = [b"".join(bytes([1, x]) if x < 9 or x > 0x7F else bytes([x]) for x in c) for c in chunks]
    if trailing:
        chunks = [c + b"\x81" for c in chunks]
    exth = b""
    if author:
        rec = struct.pack(">II", 100, 8 + len(author)) + author.encode()
        exth = b"EXTH" + struct.pack(">II", 12 + len(rec), 1) + rec
    head_len = 0xE8
    head = bytearray(0x10 + head_len)
    struct.pack_into(">HHIHHH", head, 0, compression, 0, len(text), len(chunks), size, encryption)
    head[0x10:0x14] = b"MOBI"
    struct.pack_into(">I", head, 0x14, head_len)
    struct.pack_into(">I", head, 0x1C, codepage)
    struct.pack_into(">I", head, 0x24, version)
    struct.pack_into(">I", head, 0x54, len(head) + len(exth))
    struct.pack_into(">I", head, 0x58, len(name.encode()))
    struct.pack_into(">I", head, 0x68, version)
    struct.pack_into(">I", head, 0xA8, 0xFFFFFFFF)
    if trailing:
        struct.pack_into(">H", head, 0xF2, trailing)
    records = [bytes(head) + exth + name.encode(), *chunks]
    out = bytearray(78)
    struct.pack_into(">H", out, 76, len(records))
    at = 78 + 8 * len(records)
    table = b""
    for r in records:
        table += struct.pack(">II", at, 0)
        at += len(r)
    return bytes(out) + table + b"".join(records)


def manuscript(rng: random.Random, chapters: int, words: tuple[int, int] = (40, 180)) -> str:
    """A plain text of chapters, two to five scenes each, four to twenty-two paragraphs a scene."""
    parts = []
    for c in range(1, chapters + 1):
        scenes = ["\n\n".join(paragraph(rng, rng.randint(*words)) for _ in range(rng.randint(4, 22))) for _ in range(rng.randint(2, 5))]
        parts.append(f"Chapter {c}\n\n" + "\n\n* * *\n\n".join(scenes))
    return "\n\n".join(parts)


def library(seed: int = 1, kept: int = 13, left_out: int = 5) -> dict[str, bytes]:
    """Path -> content of a library: `kept` books of 10 to 22 chapters on two shelves, by turns as text, EPUB, HTML and DOCX, and `left_out` shorter ones in a folder of their own."""
    rng = random.Random(seed)
    out: dict[str, bytes] = {}
    for i in range(kept + left_out):
        text = manuscript(rng, rng.randint(10, 22) if i < kept else rng.randint(8, 12))
        name = f"{'shelf_' + str(i % 2) if i < kept else 'out of print'}/{rng.choice(WORDS)}_{rng.choice(WORDS)}_{i:02}"
        chapters = [c.split("\n\n") for c in text.split("Chapter ")[1:]]
        if i % 4 == 1:
            pages = {f"c{n:02}.xhtml": f"<h2>Chapter {c[0]}</h2>" + "".join("<hr/>" if p == "* * *" else f"<p>{p}</p>" for p in c[1:] if p) for n, c in enumerate(chapters)}
            out[name + ".epub"] = epub(pages, name.rsplit("/", 1)[1])
        elif i % 4 == 2:
            out[name + ".html"] = ("<body>" + "".join(f"<h1>Chapter {c[0]}</h1>" + "".join("<hr/>" if p == "* * *" else f"<p>{p}</p>" for p in c[1:] if p) for c in chapters) + "</body>").encode()
        elif i % 4 == 3:
            out[name + ".docx"] = docx([("H1", f"Chapter {c[0]}") if n == 0 else (None, p) for c in chapters for n, p in enumerate(c) if p], name.rsplit("/", 1)[1])
        else:
            out[name + ".txt"] = text.encode()
    return out
