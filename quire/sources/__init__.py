"""Readers from files to blocks, and sinks."""
