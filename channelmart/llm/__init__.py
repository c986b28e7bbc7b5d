"""Operators of a training-data pipeline: language identification, tokenisation, personal data, duplicate
text, page extraction, vector search, packing, quality rules and language-model scoring."""
