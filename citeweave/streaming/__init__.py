"""Structured Streaming ingest of publication records."""
