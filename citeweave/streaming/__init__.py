"""Incremental variants of the bulk and enrichment jobs."""
