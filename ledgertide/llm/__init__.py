"""Operators for preparing training data: archives, language, shards, near copies,
main text, mixing, repeated passages, quality, token counts, contamination."""
