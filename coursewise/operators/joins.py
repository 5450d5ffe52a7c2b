"""Join helpers that stay correct and balanced when one key is hot."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def left_join_skew_safe(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """``left LEFT JOIN right USING (keys)`` written as one inner join.

    In an outer join Spark's adaptive skew handling may only split the
    preserved (left) side; a hot key on the right side would land in one
    task. Here the right side gets a row without payload for each of the left
    side's distinct keys that it lacks, and an inner join, which can be split
    on either side, gives the rows of the left join. The left side is read
    once in full and once for its keys.
    """
    extra = [c for c in right.columns if c not in keys]
    types = dict(right.dtypes)
    known = right.dropna(subset=keys)  # NULL keys never match
    lacking = (left.select(*[F.col(k).cast(types[k]).alias(k) for k in keys]).distinct()
               .join(known.select(*keys).distinct(), keys, "left_anti"))
    filled = known.select(*keys, *extra).unionByName(
        lacking.select(*keys, *[F.lit(None).cast(types[c]).alias(c) for c in extra]))
    right_key = {k: f"_right_{k}" for k in keys}
    filled = filled.withColumnsRenamed(right_key)
    same = [F.col(k).eqNullSafe(F.col(right_key[k])) for k in keys]
    return left.join(filled, same).select(*left.columns, *extra)
