"""Invented manuscripts in every format."""

from quire.sources.demo import WORDS, docx, epub, library, mobi, nav_points, paragraph

__all__ = ["WORDS", "docx", "epub", "library", "mobi", "nav_points", "paragraph"]
