"""Lookup errors."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .fixed_values import RETRYABLE_ERRORS, RETRYABLE_HTTP_CODES


def is_retryable(error_type: Column, retry_http: bool = False) -> Column:
    """True for errors worth another try; ``retry_http`` adds throttling and server errors."""
    pattern = "|".join(RETRYABLE_ERRORS)
    if retry_http:
        pattern += "|HTTP_(?:" + "|".join(map(str, RETRYABLE_HTTP_CODES)) + ")"
    return F.coalesce(error_type.rlike(pattern), F.lit(False))
