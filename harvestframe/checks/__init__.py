"""Correctness oracles: DuckDB SQL equivalents of the registered queries, and output normalisation."""
