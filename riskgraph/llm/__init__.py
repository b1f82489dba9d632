"""Operators of a training-data pipeline (documents, pages, benchmark tables)."""
