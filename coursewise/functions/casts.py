"""H2: typed casts with a default for blank or unparsable text.

Integer parsing follows Java's ``Integer.parseInt`` / ``Long.parseLong``:
optional sign and digits, no surrounding blanks (so ' 12' gives the
default). Double parsing trims, like ``Double.parseDouble``. A boolean is
true only for 'true' in any case; everything else, blank included, is false.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import is_blank

_INT_TEXT = r"^[+-]?[0-9]+\z"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def cast_string(c, default: str = "") -> Column:
    return F.coalesce(_c(c).cast("string"), F.lit(default))


def cast_int(c, default: int = 0) -> Column:
    c = _c(c).cast("string")
    ok = ~is_blank(c) & c.rlike(_INT_TEXT)
    return F.coalesce(F.when(ok, c.try_cast("int")), F.lit(default))


def cast_long(c, default: int = 0) -> Column:
    c = _c(c).cast("string")
    ok = ~is_blank(c) & c.rlike(_INT_TEXT)
    return F.coalesce(F.when(ok, c.try_cast("bigint")), F.lit(default).cast("bigint"))


def cast_double(c, default: float = 0.0) -> Column:
    c = _c(c).cast("string")
    return F.coalesce(F.when(~is_blank(c), F.trim(c).try_cast("double")), F.lit(float(default)))


def cast_boolean(c, default: bool = False) -> Column:
    c = _c(c).cast("string")
    return F.when(c.isNull(), F.lit(default)).otherwise(F.lower(c) == "true")
