"""Bounded samples for training."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_RANGE = 1 << 30


def hashed_sample(df: DataFrame, key: str, n: int) -> DataFrame:
    """The n rows with the smallest hashes of their key, all if there are fewer.

    Rows that can't be among them are left out before anything is ordered: by the number of
    rows, twice as many as wanted remain, however large the table is.
    """
    place = F.pmod(F.xxhash64(key), F.lit(_RANGE))
    share = min(1.0, 2 * n / max(1, df.count()))
    return df.where(place < F.lit(int(share * _RANGE))).orderBy(place, key).limit(n)
