"""Operators of a training-data pipeline: search, packing, language-model
scoring, near and exact deduplication, sharding, piece sampling, extraction
and toxicity. Nothing else in the library imports this subpackage."""
