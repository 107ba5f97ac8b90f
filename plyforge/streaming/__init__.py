"""Incremental ingest of newly arrived archives."""
