"""H3: URL form encoding of text columns (UTF-8, space as '+')."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def encode_url(c) -> Column:
    return F.url_encode(_c(c))


def decode_url(c) -> Column:
    """Decode; a malformed escape gives NULL instead of failing the job."""
    return F.try_url_decode(_c(c))
