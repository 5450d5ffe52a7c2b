"""H4: emptiness tests for string, array and map columns (NULL counts as empty)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import is_blank


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def string_empty(c) -> Column:
    return is_blank(c)


def array_empty(c) -> Column:
    return F.coalesce(F.size(_c(c)) == 0, F.lit(True)) | _c(c).isNull()


def map_empty(c) -> Column:
    return F.coalesce(F.size(_c(c)) == 0, F.lit(True)) | _c(c).isNull()
