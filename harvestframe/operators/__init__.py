"""Relational building blocks: windows, EMA scan, as-of join, reshapes, stats, contracts, quality."""
