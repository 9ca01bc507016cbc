"""Operators of training-data pipelines: formatting, extraction, deduplication, packing, filtering."""
