"""Whole-corpus plans: build pipeline, statistics, reports, session helpers."""
