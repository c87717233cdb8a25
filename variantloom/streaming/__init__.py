"""Incremental runs of the same merges."""
