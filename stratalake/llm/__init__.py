"""Operators for preparing training text: dedup, quality, packing, scans, tokens, embeddings, URLs."""
