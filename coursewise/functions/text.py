"""String cleaning and masking columns.

All are built-in expressions, no Python UDF. They run in generated code, but for
the places that use them inside a ``filter`` lambda, which Spark evaluates
expression by expression. Where the reference's
Java helpers would throw on bad input, these return NULL so the caller can
route the row to a reject output instead of failing the job.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Java's String.trim removes every char <= U+0020 (controls and space);
# Spark's plain trim removes spaces only, so trim this set explicitly.
_JAVA_WS = "".join(chr(i) for i in range(0x21))


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def java_trim(c) -> Column:
    """Trim every character <= U+0020 from both ends."""
    return F.btrim(_c(c), F.lit(_JAVA_WS))


def is_blank(c) -> Column:
    """NULL or only whitespace/control characters."""
    c = _c(c)
    return c.isNull() | (F.length(java_trim(c)) == 0)


def split_fields(line, sep: str = "\t") -> Column:
    """Split keeping empty fields (like Java split with trailing empties kept)."""
    return F.split(_c(line), sep, -1)


def field_count(line, sep: str = "\t") -> Column:
    """Number of fields as Java ``String.split`` counts them.

    Java drops trailing empty fields, so trailing separators are removed
    before splitting; ``a\\tb\\t\\t`` has 2 fields, not 4.
    """
    return F.size(F.split(F.regexp_replace(_c(line), f"(?:{sep})+\\z", ""), sep, -1))


def field_count_ok(line, n: int = 17, sep: str = "\t") -> Column:
    """Keep a line only when it has exactly ``n`` fields."""
    return field_count(line, sep) == n


def fields_ok(fields, n: int = 17) -> Column:
    """C1 on the fields of ``split_fields``: field n holds something and all behind it are empty (n is 2 at least)."""
    f = _c(fields)
    return (F.get(f, F.lit(n - 1)) != "") & ((F.size(f) == n) | F.forall(F.slice(f, n + 1, F.size(f)), lambda x: x == ""))


def mask_phone(c, filler: str = "xxxx", keep_blank: bool = True) -> Column:
    """Chars 1-3 + filler + chars 8-11.

    ``keep_blank`` (C2) leaves a blank value as it is; without it (C10) a
    NULL phone stays NULL. A non-blank value shorter than 11 characters,
    which makes the reference fail, gives NULL. Characters past the 11th
    are dropped, as in the reference.
    """
    c = _c(c)
    masked = F.concat(F.substring(c, 1, 3), F.lit(filler), F.substring(c, 8, 4))
    expr = F.when(F.length(c) >= 11, masked)
    if keep_blank:
        expr = F.when(is_blank(c), c).otherwise(expr)
    return expr


def strip_newlines(c) -> Column:
    """Remove line feeds (kept NULL-safe; blank values end up the same)."""
    return F.regexp_replace(_c(c), "\n", "")


def mask_name(c) -> Column:
    """First character + 'xx'; NULL or empty gives NULL."""
    c = _c(c)
    return F.when(F.length(c) >= 1, F.concat(F.substring(c, 1, 1), F.lit("xx")))


def redact() -> Column:
    """C11: constant replacement of a secret."""
    return F.lit("******")


# Registration source code -> label (anything else -> 'other').
REGSOURCE_LABELS = {"1": "PC", "2": "Mobile", "3": "App", "4": "WeChat"}


def code_label(c, labels: dict | None = None, default: str = "other") -> Column:
    """Code -> label through a literal map; unknown or NULL -> default."""
    labels = labels or REGSOURCE_LABELS
    m = F.create_map(*[x for k, v in labels.items() for x in (F.lit(k), F.lit(v))])
    return F.coalesce(F.try_element_at(m, _c(c).cast("string")), F.lit(default))


def is_int_text(c) -> Column:
    """Text that Java ``Integer.parseInt`` accepts (sign + digits, int range)."""
    c = _c(c)
    return c.rlike(r"^[+-]?[0-9]+\z") & c.try_cast("int").isNotNull()
