"""Bounded samples by hash, for fitting models."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def crc_bucket(id_col: str, n: int) -> Column:
    """crc32 of the id as text, modulo ``n``; null for a null id."""
    return F.crc32(F.col(id_col).cast("string")) % n


def about(df: DataFrame, key: str, size: int, seed: int = 17) -> DataFrame:
    """About ``size`` rows of ``df`` (all, if it has fewer), by a hash of ``key``: the same rows on every run.

    Hashes are uniform, so twice ``size`` is never reached in practice; rows
    that share a key come or go together.
    """
    n = df.count()
    if n <= size:
        return df
    span = 1 << 30
    return df.where(F.pmod(F.xxhash64(F.lit(seed), F.col(key).cast("string")), F.lit(span)) < int(span * size / n))
