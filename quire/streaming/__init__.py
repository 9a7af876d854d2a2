"""Incremental forms: new rows or files as they arrive."""
