"""EPUB and DOCX containers, from their bytes, with the standard library."""

from __future__ import annotations

import io
import posixpath
import re
import zipfile
from dataclasses import dataclass, field
from urllib.parse import unquote

from quire.functions import text as X
from quire.functions.pytext import CHAPTER, clean_heading, clean_inline, is_nav_furniture, is_scene_break
from quire.sources.markup import Node, html_blocks, parse

Block = tuple[str, str, int, str]
#: Media types of prose, the form of an ISBN in a file name.
HTML_TYPES = {"application/xhtml+xml", "text/html", "application/x-dtbook+xml", ""}
ISBN = re.compile(r"(97[89]\d{10})")
_LABEL = re.compile(rf"(?i)^\s*(?:book|volume|tome)\s+{X.NAV_NUMBER}\b")
_LABEL_TITLE = re.compile(rf"(?i)^\s*(?:book|volume|tome)\s+{X.NAV_NUMBER}\b\s*(?:[-–—:]\s*)?(?P<title>\S.*?)\s*$")
_OMNIBUS = re.compile(X.OMNIBUS_PATTERN)


@dataclass
class Document:
    """One book's worth of blocks with what its container says about it."""

    blocks: list[Block]
    meta: dict[str, str] = field(default_factory=dict)


@dataclass
class NavPoint:
    label: str
    src: str
    children: int
    first_child: str


class Archive:
    """A zip whose entries are found whatever their case; broken entries read as nothing."""

    def __init__(self, data: bytes):
        self.zip = zipfile.ZipFile(io.BytesIO(data))
        self.names = self.zip.namelist()
        self.lower = {n.lower(): n for n in self.names}

    def read(self, name: str) -> bytes | None:
        try:
            return self.zip.read(self.lower[name.lower()])
        except Exception:  # a missing or damaged entry is no reason to lose the book
            return None

    def tree(self, name: str | None) -> Node | None:
        raw = self.read(name) if name else None
        return parse(raw.decode("utf-8", "replace"), xml=True) if raw else None


def _words(n: Node | None) -> str:
    return re.sub(r"\s+", " ", " ".join(t.strip() for t in n.texts() if t.strip())).strip() if n else ""


def looks_like_html(name: str, media: str, properties: str) -> bool:
    """Whether a manifest entry is prose."""
    low = name.lower()
    return "nav" not in properties.lower() and (low.endswith((".xhtml", ".html", ".htm")) or media in HTML_TYPES and low.endswith(".xml"))


def epub_parts(data: bytes) -> tuple[dict[str, str], list[tuple[str, str]]]:
    """(metadata, [(entry, markup)]) in reading order; falls back from spine to manifest to whatever looks like HTML."""
    z = Archive(data)
    root = z.tree("META-INF/container.xml")
    rootfile = root.find("rootfile") if root else None
    opf_name = (rootfile.attrs.get("full-path") if rootfile else None) or next((n for n in z.names if n.lower().endswith(".opf")), None)
    opf = z.tree(opf_name)
    meta: dict[str, str] = {}
    chosen: list[tuple[str, str, str]] = []
    if opf:
        for key, tidy in (("title", clean_heading), ("creator", str), ("description", lambda t: clean_inline(t)[:2000])):
            if text := next((t for n in opf.find_all(key) if (t := _words(n))), ""):
                meta[key] = tidy(text)
        base, by_id, manifest = posixpath.dirname(opf_name), {}, []
        for item in opf.find_all("item"):
            if href := item.attrs.get("href"):
                entry = (posixpath.normpath(posixpath.join(base, unquote(href))), item.attrs.get("media-type", "").strip().lower(), item.attrs.get("properties", "").strip())
                manifest.append(entry)
                if item.attrs.get("id"):
                    by_id[item.attrs["id"]] = entry
        spine = [by_id[r.attrs.get("idref")] for r in opf.find_all("itemref") if r.attrs.get("idref") in by_id]
        chosen = [e for e in spine or manifest if looks_like_html(*e)]
    if not chosen:
        chosen = [(n, "", "") for n in z.names if n.lower().endswith((".xhtml", ".html", ".htm"))]
    parts = [(n, raw.decode("utf-8", "replace")) for n in dict.fromkeys(e[0] for e in chosen) if (raw := z.read(n))]
    return meta, parts


def epub_navigation(data: bytes) -> tuple[str | None, list[NavPoint]]:
    """(title, top-level entries) of the NCX."""
    try:
        z = Archive(data)
        ncx = z.tree(next((n for n in z.names if n.lower().endswith(".ncx")), None))
    except Exception:
        return None, []
    if ncx is None:
        return None, []
    title = next((t for n in ncx.find_all("doctitle") if (t := clean_heading(_words(n)))), None)
    points = []
    for p in (ncx.find("navmap") or Node("")).children:
        if isinstance(p, str) or p.name != "navpoint":
            continue
        own = [c for c in p.children if isinstance(c, Node)]
        inner = [c for c in own if c.name == "navpoint"]
        label = _words(next((c for c in own if c.name == "navlabel"), None)) or _words(p.find("text"))
        content = next((c for c in own if c.name == "content"), None) or p.find("content")
        points.append(NavPoint(label, (content.attrs.get("src", "") if content else "").split("#")[0], len(inner), _words(inner[0].find("text")) if inner else ""))
    return title, points


def part_index(names: list[str], src: str) -> int | None:
    """The part an entry points at: exact or by its path's end; by its bare name only when it has no folder."""
    src = src.split("#")[0].lstrip("./")
    if not src:
        return None
    exact = next((i for i, n in enumerate(names) if n == src or n.endswith("/" + src)), None)
    if exact is None and "/" not in src.replace("\\", "/"):
        exact = next((i for i, n in enumerate(names) if posixpath.basename(n) == src), None)
    return exact


def isbn_groups(names: list[str], points: list[NavPoint]) -> list[tuple[str, list[int]]] | None:
    """Books by the ISBN in their files' names: two or more, three files each; files without one belong to none."""
    groups: dict[str, list[int]] = {}
    for i, n in enumerate(names):
        if m := ISBN.search(n):
            groups.setdefault(m.group(1), []).append(i)
    if len(groups) < 2 or min(map(len, groups.values())) < 3:
        return None
    titles: dict[str, NavPoint] = {}
    for p in points:
        m = ISBN.search(p.src)
        if m and not is_nav_furniture(p.label) and (m.group(1) not in titles or p.children > titles[m.group(1)].children):
            titles[m.group(1)] = p
    return [(clean_heading(titles[k].label) if k in titles else k, g) for k, g in groups.items()]


def navigation_groups(names: list[str], points: list[NavPoint], labelled: bool) -> list[tuple[str, list[int]]] | None:
    """Books by top-level entries with five or more children; labelled: only entries named like "Book Two"."""
    starts: dict[int, str] = {}
    novels = [p for p in points if p.children >= 5 and not is_nav_furniture(p.label) and (not labelled or _LABEL.match(p.label))]
    if len(novels) < 2:
        return None
    for p in novels:
        at = part_index(names, p.src)
        if at is None or at in starts:
            continue
        m = _LABEL_TITLE.match(p.label)
        title = m.group("title") if m else p.label
        if not m and _LABEL.match(p.label) and p.first_child and not _LABEL.match(p.first_child) and not is_nav_furniture(p.first_child):
            title = p.first_child
        starts[at] = clean_heading(title) or f"Book {len(starts) + 1}"
    order = sorted(starts)
    if len(order) < 2:
        return None
    bounds = [0, *order[1:], len(names)]
    groups = [(starts[at], list(range(a, b))) for at, a, b in zip(order, bounds, bounds[1:]) if b > a]
    return groups if len(groups) > 1 else None


def epub_documents(data: bytes, stem: str, split_omnibus: bool = True) -> list[Document]:
    """One document, or one a novel for collections."""
    meta, parts = epub_parts(data)
    names, collection = [n for n, _ in parts], meta.get("title") or stem

    def blocks(indices: list[int]) -> list[Block]:
        kept = [parts[i] for i in indices if not any(h in parts[i][0].lower() for h in X.SKIPPED_PARTS)]
        return [(*b, f"epub:{n}") for n, markup in kept for b in html_blocks(markup, f"epub:{n}")]

    groups = None
    if split_omnibus:
        title, points = epub_navigation(data)
        hint = _OMNIBUS.search(" ".join(t for t in (title, meta.get("title"), meta.get("description")) if t))
        groups = isbn_groups(names, points) or navigation_groups(names, points, True) or (navigation_groups(names, points, False) if hint else None)
    if not groups:
        return [Document(blocks(list(range(len(parts)))), {**meta, "title": collection})]
    return [
        Document(blocks(of), {**meta, "title": title or f"{collection} — book {i}", "collection": collection, "part_index": str(i), "part_count": str(len(groups))})
        for i, (title, of) in enumerate(groups, 1)
    ]


def docx_document(data: bytes, stem: str, origin: str) -> Document:
    """Body paragraphs of a Word file; tables are left out."""
    z = Archive(data)
    styles = {s.attrs.get("w:styleid", ""): (s.find("name").attrs.get("w:val", "") if s.find("name") else "").lower() for s in (z.tree("word/styles.xml") or Node("")).find_all("style")}
    document = z.tree("word/document.xml")
    if document is None:
        raise ValueError("no document part")
    blocks: list[Block] = []
    for p in (document.find("body") or Node("")).children:
        if isinstance(p, str) or p.name != "p":
            continue
        raw = "".join("".join(r.texts()) if r.name == "t" else "\t" if r.name == "tab" else "\n" if r.name in ("br", "cr") else "" for r in p.walk() if r.name in ("t", "tab", "br", "cr"))
        text = clean_inline(raw)
        if not text:
            continue
        style_node = p.find("pstyle")
        ident = style_node.attrs.get("w:val", "") if style_node else ""
        style = styles.get(ident, ident.lower())
        if style.startswith("heading") or style in ("title", "subtitle"):
            m = re.search(r"\d+", style)
            level = {"title": 1, "subtitle": 2}.get(style) or (2 if m and int(m.group()) > 2 else 1)
            blocks.append(("heading", clean_heading(text), level, origin))
        elif is_scene_break(text):
            blocks.append(("scene_break", "", 0, origin))
        elif len(text) <= 70 and CHAPTER.match(text):
            blocks.append(("heading", clean_heading(text), 1, origin))
        else:
            blocks.append(("paragraph", text, 0, origin))
    core = z.tree("docProps/core.xml")
    title = clean_heading(_words(core.find("title"))) if core and core.find("title") else ""
    return Document(blocks, {"title": title or stem})
