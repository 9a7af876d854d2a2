"""HTML and XHTML to blocks: a small tolerant tree, and one walk over it."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from html.parser import HTMLParser

from quire.functions.pytext import CHAPTER, clean_heading, clean_inline, is_scene_break

# Fixed values ---------------------------------------------------------------
BLOCKS = set("p div section article blockquote aside figure figcaption td li dd dt pre address".split())
HEADINGS = {f"h{i}": i for i in range(1, 7)}
SKIPPED = set("script style nav head title meta link img image svg figure audio video object iframe pagebreak pagetemplate pagemap pagemapproc".split())
BREAK_HINTS = "scene-break scenebreak dinkus section-break sectionbreak separator divider ornament asterism hr break space".split()
HEADING_HINTS = "chapter title heading heading1 chapter-title".split()
CHAPTER_CLASSES = set(
    "chapter chapno chap-no chaptitle chaptertitle chapter-title chapter-number chapternumber chapterhead chapter-head chaptername chapter-name chapternum".split()
)
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
# ----------------------------------------------------------------------------
#: Elements that a new one of the second set closes when it opens.
_CLOSES = [({"p"}, BLOCKS | set(HEADINGS) | {"hr", "ul", "ol", "table", "dl", "form", "header", "footer", "main"}), ({"li"}, {"li"}), ({"dd", "dt"}, {"dd", "dt"}), ({"td", "th"}, {"td", "th", "tr"}), ({"tr"}, {"tr"})]
_LINE = "\ue000"


@dataclass
class Node:
    name: str
    attrs: dict[str, str] = field(default_factory=dict)
    children: list = field(default_factory=list)

    def texts(self) -> Iterator[str]:
        for c in self.children:
            if isinstance(c, str):
                yield c
            else:
                yield from c.texts()

    def walk(self) -> Iterator[Node]:
        for c in self.children:
            if isinstance(c, Node):
                yield c
                yield from c.walk()

    def find(self, name: str) -> Node | None:
        return next((n for n in self.walk() if n.name == name), None)

    def find_all(self, name: str) -> list[Node]:
        return [n for n in self.walk() if n.name == name]

    def text(self) -> str:
        return clean_inline(" ".join(self.texts()).replace("\r", " ").replace("\n", " "))


class _Builder(HTMLParser):
    def __init__(self, xml: bool):
        super().__init__(convert_charrefs=True)
        self.xml, self.root = xml, Node("#root")
        self.stack = [self.root]

    def handle_starttag(self, tag: str, attrs: list) -> None:
        name = tag.rpartition(":")[2]
        if not self.xml:
            for closed, openers in _CLOSES:
                if name in openers:
                    for i in range(len(self.stack) - 1, 0, -1):
                        if self.stack[i].name in closed:
                            del self.stack[i:]
                            break
                        if self.stack[i].name in ("table", "ul", "ol", "body", "blockquote", "div", "section", "article"):
                            break
        node = Node(name, {k: v or "" for k, v in attrs})
        self.stack[-1].children.append(node)
        if name not in VOID or self.xml and name not in ("br", "hr", "img", "meta", "link"):
            self.stack.append(node)

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        name = tag.rpartition(":")[2]
        if not self.xml and name not in VOID and name not in SKIPPED:
            self.handle_starttag(tag, attrs)
            return
        self.stack[-1].children.append(Node(name, {k: v or "" for k, v in attrs}))

    def handle_endtag(self, tag: str) -> None:
        name = tag.rpartition(":")[2]
        for i in range(len(self.stack) - 1, 0, -1):
            if self.stack[i].name == name:
                del self.stack[i:]
                return

    def handle_data(self, data: str) -> None:
        self.stack[-1].children.append(data)

    def handle_comment(self, data: str) -> None:
        # a comment right under a container counts as text there
        self.stack[-1].children.append(Node("#comment", {}, [data]))


def parse(markup: str, xml: bool = False) -> Node:
    """The tree of a document; anything unclosed ends with it."""
    b = _Builder(xml)
    b.feed(markup)
    b.close()
    return b.root


def _prune(node: Node) -> None:
    node.children = [c for c in node.children if isinstance(c, str) or c.name not in SKIPPED]
    for c in node.children:
        if isinstance(c, Node):
            _prune(c)


def _hints(n: Node) -> str:
    return " ".join([*n.attrs.get("class", "").split(), n.attrs.get("id", ""), n.attrs.get("epub:type", "")]).lower()


def _holds_blocks(n: Node) -> bool:
    return any(isinstance(c, Node) and (c.name in BLOCKS or c.name in HEADINGS or c.name in ("hr", "ul", "ol", "table")) for c in n.children)


def font_size(n: Node) -> int:
    """Largest font size inside an element; relative sizes count from 3, smaller ones not at all."""
    sizes = [0]
    for f in n.find_all("font"):
        m = re.fullmatch(r"\s*(\+?)(\d+)\s*", f.attrs.get("size", ""))
        if m:
            sizes.append(int(m.group(2)) + (3 if m.group(1) else 0))
    return max(sizes)


def is_centred(n: Node) -> bool:
    hints = _hints(n)
    return n.attrs.get("align", "").strip().lower() in ("center", "centre", "middle") or "center" in hints or "centre" in hints


def display_level(text: str, size: int, centred: bool) -> int:
    """1 for a short line that looks like a title, else 0."""
    words = text.split()
    if not text or len(text) > 60 or not 1 <= len(words) <= 8 or not any(c.isalnum() for c in text) or text.endswith((".", "?", "!", "”", '"')):
        return 0
    return int(size >= 5 or size >= 3 and centred or centred and len(words) <= 4 and len(text) <= 34)


def _block_of(text: str) -> tuple[str, str, int]:
    return ("scene_break", "", 0) if is_scene_break(text) else ("paragraph", text, 0)


def _walk(node: Node, level: int) -> Iterator[tuple[str, str, int]]:
    for c in node.children:
        if isinstance(c, str) or c.name == "#comment":
            text = clean_inline(c if isinstance(c, str) else "".join(c.children))
            if len(text) > 1 and any(x.isalnum() for x in text):
                yield _block_of(text)
        elif c.name == "hr":
            yield ("scene_break", "", 0)
        elif c.name in HEADINGS:
            if text := clean_heading(" ".join(c.texts()).replace("\r", " ").replace("\n", " ")):
                yield ("heading", text, level if HEADINGS[c.name] <= 2 else 2)
        elif c.name in BLOCKS:
            yield from _walk_block(c, level)
        elif _holds_blocks(c):
            yield from _walk(c, level)
        elif text := c.text():
            yield ("paragraph", text, 0)


def _walk_block(c: Node, level: int) -> Iterator[tuple[str, str, int]]:
    text, hints = c.text(), _hints(c)
    hinted = any(h in hints for h in BREAK_HINTS)
    if not text:
        if c.name == "div" and hinted:
            yield ("scene_break", "", 0)
        return
    chapter_class = c.name == "p" and CHAPTER_CLASSES & {x.lower() for x in c.attrs.get("class", "").split()}
    if c.name == "p" and len(text) <= 90 and any(h in hints for h in HEADING_HINTS) and not (hinted and is_scene_break(text)) and CHAPTER.match(text):
        yield ("heading", clean_heading(text), 1)
    elif is_scene_break(text):
        yield ("scene_break", "", 0)
    elif chapter_class and len(text) <= 90 and any(x.isalnum() for x in text):
        yield ("heading", clean_heading(text), 1)
    elif _holds_blocks(c):
        yield from _walk(c, level)
    elif display_level(text, font_size(c), is_centred(c)):
        yield ("heading", clean_heading(text), 1)
    else:
        for piece in " ".join(c.texts()).split(_LINE):
            if piece := clean_inline(piece.replace("\r", " ").replace("\n", " ")):
                yield _block_of(piece)


def html_blocks(markup: str, origin: str = "", level: int = 1, xml: bool | None = None) -> list[tuple[str, str, int]]:
    """(kind, text, level) of a document in order. xml: None decides by the origin's suffix or an XML declaration."""
    if xml is None:
        xml = origin.endswith((".xhtml", ".xml")) or "<?xml" in markup[:200]
    root = parse(re.sub(r"(?i)<br\s*/?>", _LINE, markup), xml)
    _prune(root)
    body = root.find("body") or root
    return [b for b in _walk(body, level) if b[0] != "paragraph" or b[1].split()]
