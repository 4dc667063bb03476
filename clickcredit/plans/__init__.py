"""Composed plans: registered queries, the DuckDB oracle, the batch job and file router."""
