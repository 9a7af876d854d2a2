"""The text rules once more for code that already runs in a Python worker; the JVM-side ones are in functions.text."""

from __future__ import annotations

import re
import unicodedata

from quire.functions import text as X

_DROP = {ord(c): None for c in X.INVISIBLE} | {ord(c): " " for c in X.BLANKS}
_EDGE = " .—–-"


ORNAMENTS, STRONG = set(X.ORNAMENTS), set(X.STRONG)
CHAPTER = re.compile(rf"^\s*(?:{'|'.join(X.CHAPTER_WORDS)})\b[\s.:—–-]*(?:\d{{1,3}}|[ivxlcdm]{{1,7}}|{'|'.join(X.NUMBER_WORDS)})?\b[^\n]{{0,60}}$", re.I)


def clean_inline(text: str | None) -> str:
    """One paragraph's text; null gives the empty string."""
    if not text:
        return ""
    t = unicodedata.normalize("NFC", text).translate(_DROP)
    return re.sub(r"\s+([,.;:!?…])", r"\1", re.sub(r"[^\S\n]+", " ", t)).strip()


def clean_heading(text: str | None) -> str:
    return clean_inline(text).strip(_EDGE).strip()


def clean_label(raw: str) -> str:
    t = re.sub(r"<[^>]*>", " ", raw)
    for a, b in X.LABEL_ENTITIES:
        t = t.replace(a, b)
    return re.sub(r"\s+", " ", t).strip().lstrip("> ").strip()


def is_scene_break(line: str, aggressive: bool = False) -> bool:
    s = line.strip()
    if not 0 < len(s) <= 40:
        return False
    if s in STRONG:
        return True
    solid = [c for c in s if not c.isspace()]
    if len(solid) >= 3 and ORNAMENTS.issuperset(solid):
        return True
    return aggressive and len(set(s)) == 1 and s[0] in "-–—_=*"


def is_nav_furniture(label: str | None) -> bool:
    low = (label or "").strip().lower()
    return not low or low in X.NAV_FURNITURE or low.startswith("about ")


def decode_text(data: bytes) -> str:
    """The first of UTF-8 with or without mark, Windows-1252, Latin-1 that decodes."""
    for page in ("utf-8-sig", "cp1252"):
        try:
            return data.decode(page)
        except UnicodeDecodeError:
            pass
    return data.decode("latin-1")


def text_blocks(text: str, aggressive: bool = False, numbered: bool = False, strip_pages: bool = False) -> list[tuple[str, str, int]]:
    """(kind, text, level) of a plain or Markdown text, in order."""
    out: list[tuple[str, str, int]] = []
    open_lines: list[str] = []

    def close() -> None:
        if open_lines:
            joined = re.sub(r"(\w)-\n(\w)", r"\1\2", "\n".join(open_lines))
            body = clean_inline(" ".join(x.strip() for x in joined.split("\n")))
            if body:
                out.append(("paragraph", body, 0))
            open_lines.clear()

    lines = re.sub(r"\n{3,}", "\n\n", text.replace("\r\n", "\n").replace("\r", "\n")).split("\n")
    for line in lines:
        s = line.strip()
        if strip_pages and re.fullmatch(r"(?i)\d{1,4}|page\s+\d{1,4}( of \d{1,4})?", s):
            continue
        mark = re.match(r"^\s{0,3}(#{1,6})\s+(.+?)\s*#*\s*$", line)
        if not s:
            close()
        elif mark:
            close()
            if head := clean_heading(mark.group(2)):
                out.append(("heading", head, 1 if len(mark.group(1)) <= 2 else 2))
        elif is_scene_break(line, aggressive) or numbered and re.fullmatch(r"[1-9]\d{0,2}", s):
            close()
            out.append(("scene_break", "", 0))
        elif len(s) <= 70 and CHAPTER.match(s) and not open_lines:
            if head := clean_heading(s):
                out.append(("heading", head, 1))
        else:
            open_lines.append(line)
    close()
    return out
