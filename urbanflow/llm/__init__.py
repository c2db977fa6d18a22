"""Operators for large text corpora: near and exact duplicates, extraction, tokens, packing, quality, scoring."""
