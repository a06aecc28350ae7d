"""Incremental runs over newly dropped files."""
