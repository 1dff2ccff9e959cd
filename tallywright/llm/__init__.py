"""Operators for large text corpora: scoring, de-duplication, secrets, languages, mixing, packing, output and search."""
