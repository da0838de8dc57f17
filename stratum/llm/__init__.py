"""Operators of a training-data pipeline (WARC, toxicity, language model,
packing, span dedup, PII, mixing, SimHash, vector search).

Nothing else in the library imports this subpackage.
"""
