"""Bounded streaming ingest."""
