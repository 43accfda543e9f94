"""Operators for training-data pipelines: tokens, extraction, scoring, duplicates, sharding."""
