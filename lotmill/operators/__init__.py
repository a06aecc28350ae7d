"""Operators over whole DataFrames: clean, gate, dedup, merge, number, extract."""
