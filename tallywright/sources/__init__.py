"""Ingest of nested JSON payloads and tagged tables, and the gated publish."""
