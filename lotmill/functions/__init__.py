"""Column rules: each function maps columns to a column and stays JVM-side."""
