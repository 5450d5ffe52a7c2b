"""The query catalog: every registered query and its DuckDB oracle.

Each builder takes ``(spark, sf_dir)`` and returns a lazy DataFrame over the
whole driver tables (or tables Spark derives from them). The oracle is an
independent SQL formulation, written in the reference's literal shape
(joins of per-step subqueries, unions of padded aggregates) wherever the
Spark side uses a one-pass rewrite, so the check also proves the rewrite.
Modules register in import order; later ones reuse earlier oracles.
"""

from . import behavior, reports, cleaning, feeds, wide, helpers, sinks  # noqa: F401  (registration)
from .base import ORACLES, QUERIES, register  # noqa: F401
