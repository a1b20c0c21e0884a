"""Operators for building training data: classification, deduplication, extraction, tokens, search."""
