"""Composed jobs: the query catalog, its DuckDB oracle and the file exports."""
