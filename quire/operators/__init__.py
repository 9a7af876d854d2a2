"""Relational operators of the engine: blocks, hierarchy, packing, checks, splits, statistics."""
