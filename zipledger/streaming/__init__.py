"""Structured Streaming variants: manifest ingestion, status commits, stateful packing."""
