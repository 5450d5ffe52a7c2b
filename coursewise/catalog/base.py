"""Shared pieces of the query catalog: the registry, the inputs the queries
derive from the driver tables, and the SQL fragments their oracles share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..operators import quiz as QZ
from ..sources import driver
from ..sources import feeds as FD
from ..sources import ods

Builder = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Builder] = {}
ORACLES: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    def deco(fn: Builder) -> Builder:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn
    return deco



_STORED: dict = {}


def stored(spark, key, build):
    """What ``build`` wrote for ``key``, built once for each application."""
    key = (spark.sparkContext.applicationId, *key)
    if key not in _STORED:
        _STORED[key] = build()
    return _STORED[key]


def behavior_input(spark, sf):
    return driver.behavior_log(driver.table(spark, sf, "events"))


def detail_input(spark, sf):
    return driver.paper_detail(driver.table(spark, sf, "lineitem"), driver.table(spark, sf, "orders"))


LOG_CTE = f"WITH log AS ({driver.behavior_log_sql()})\n"
DETAIL_CTE = f"WITH detail AS ({driver.paper_detail_sql()})\n"


_JT = r"regexp_replace({x}, '^[\x00-\x20]+|[\x00-\x20]+$', '', 'g')"


def jtrim_sql(x: str) -> str:
    return _JT.format(x=x)


def blank_sql(x: str) -> str:
    return f"({x} IS NULL OR length({jtrim_sql(x)}) = 0)"


def mask_sql(x: str, filler: str, keep_blank: bool) -> str:
    masked = f"substring({x}, 1, 3) || '{filler}' || substring({x}, 8, 4)"
    blank = f"WHEN {blank_sql(x)} THEN {x} " if keep_blank else ""
    return f"CASE {blank}WHEN length({x}) >= 11 THEN {masked} ELSE NULL END"


def fieldcount_sql(x: str) -> str:
    return f"len(string_split(regexp_replace({x}, chr(9) || '+$', ''), chr(9)))"


LINES_CTE = f"WITH lines AS ({driver.behavior_lines_sql()})\n"


def lines_input(spark, sf):
    return driver.behavior_lines(driver.table(spark, sf, "events"))



def clean_sql(good: bool, lines_cte: str | None = None) -> str:
    from ..sources.driver import BEHAVIOR_COLUMNS as BC
    f = lambda i: f"f[{i + 1}]"
    phone = mask_sql(f(9), "xxxx", True)
    reason = (f"CASE WHEN NOT (regexp_full_match({f(0)}, '[+-]?[0-9]+') "
              f"AND try_cast({f(0)} AS INTEGER) IS NOT NULL) THEN 'bad_uid' "
              f"WHEN ({phone}) IS NULL AND NOT {blank_sql(f(9))} THEN 'bad_phone' END")
    cols = [f"try_cast({f(0)} AS INTEGER) AS uid"]
    for i, name in enumerate(BC[1:], start=1):
        v = f(i)
        if name == "username":
            v = f"replace({v}, chr(10), '')"
        elif name == "phone":
            v = f"({phone})"
        cols.append(f"{jtrim_sql(v)} AS {name}")
    body = f"""
SELECT value AS line, {', '.join(cols)}, {reason} AS reject_reason
FROM (SELECT value, string_split(value, chr(9)) AS f FROM lines
      WHERE {fieldcount_sql('value')} = 17) t"""
    cte = lines_cte or LINES_CTE
    if good:
        return cte + f", p AS ({body})\nSELECT {', '.join(BC)} FROM p WHERE reject_reason IS NULL"
    return cte + f", p AS ({body})\nSELECT line, reject_reason FROM p WHERE reject_reason IS NOT NULL"


# a text file splits a value at every line break (\n, \r, \r\n) on the way back
TEXT_LINES_CTE = (f"WITH raw_lines AS ({driver.behavior_lines_sql()}),\n"
                   "lines AS (SELECT unnest(regexp_split_to_array(value, '\r\n|\r|\n')) AS value FROM raw_lines)\n")


def dwd_input(spark, sf, feed):
    return FD.ingest(ods.ods_lines(spark, sf, feed), FD.FEEDS[feed])


def dwd_ctes(*feeds) -> str:
    return "WITH " + ",\n".join(f"{FD.FEEDS[f].target} AS ({ods.expected_sql(f)})" for f in feeds) + "\n"


def reader_sql(name: str, table: str, keep_dt: bool = True) -> str:
    cols = [(c, c) if isinstance(c, str) else c for c in QZ.READ[name]]
    sel = [src if src == dst else f"{src} AS {dst}" for src, dst in cols]
    if keep_dt and "dt" not in [d for _, d in cols]:
        sel.append("dt")
    return f"SELECT {', '.join(sel)} FROM {table}"


# the good rows of the text round trip, as CTE ``cleaned``
def _typed_log_cte() -> str:
    """The good rows of the text round trip, typed and keyed by day, as CTE ``log``."""
    from ..operators.cleaning import BEHAVIOR_TYPES
    dtypes = {"bigint": "BIGINT", "int": "INTEGER"}
    cols = [f"TRY_CAST({c} AS {dtypes[BEHAVIOR_TYPES[c]]}) AS {c}" if c in BEHAVIOR_TYPES else c
            for c in driver.BEHAVIOR_COLUMNS]
    cleaned = clean_sql(True, TEXT_LINES_CTE).replace(
        "\nSELECT " + ", ".join(driver.BEHAVIOR_COLUMNS) + " FROM p WHERE reject_reason IS NULL",
        ", cleaned AS (SELECT * FROM p WHERE reject_reason IS NULL)")
    return (cleaned + ", log AS (SELECT " + ", ".join(cols) + ", CAST(strftime(make_timestamp("
            "TRY_CAST(event_time AS BIGINT) * 1000000), '%Y%m%d') AS INTEGER) AS dt FROM cleaned)\n")


STORED_LOG_CTE = _typed_log_cte()


def stored_sql(analysis_sql: str) -> str:
    """An oracle written over ``LOG_CTE``, re-aimed at the stored (cleaned, typed) log."""
    return STORED_LOG_CTE + analysis_sql[len(LOG_CTE):]


# ---------------------------------------------------------------- Spark's rounding in oracle SQL
# Spark turns a double into a decimal (casts, ``round``) through the double's
# shortest decimal text and rounds that half up (so 23/40 = 0.575 -> 0.58),
# while DuckDB rounds the binary value (0.5749999... -> 0.57). The oracles
# state Spark's rule explicitly.

def spark_decimal_sql(double_expr: str, p: int, s: int) -> str:
    """CAST(double AS DECIMAL(p,s)) the way Spark does it."""
    return f"CAST(CAST(CAST(({double_expr}) AS DOUBLE) AS VARCHAR) AS DECIMAL({p},{s}))"


def spark_round_sql(double_expr: str, digits: int) -> str:
    """round(double, digits) the way Spark does it (result double)."""
    return (f"CAST(round(CAST(CAST(CAST(({double_expr}) AS DOUBLE) AS VARCHAR) AS DECIMAL(38,18)), {digits})"
            f" AS DOUBLE)")


def spark_avg_decimal_sql(col: str, scale: int, out_p: int, out_s: int) -> str:
    """CAST(avg(decimal(., scale) col) AS DECIMAL(out_p, out_s)) the way Spark does it.

    Spark averages decimals exactly and rounds half up to ``scale + 4``
    places, then the cast rounds half up again to ``out_s`` places. Done in
    integer units: S = sum * 10^scale, n = count.
    """
    up = 10 ** 4                        # extra places of the average
    step = 10 ** (scale + 4 - out_s)    # units of the average per output unit
    s_units = f"CAST(sum({col}) * {10 ** scale} AS HUGEINT)"
    n = f"count({col})"
    avg_units = f"sign({s_units}) * ((2 * abs({s_units}) * {up} + {n}) // (2 * {n}))"
    out_units = f"sign({avg_units}) * ((2 * abs({avg_units}) + {step}) // (2 * {step}))"
    return f"CAST({out_units} / {10 ** out_s}.0 AS DECIMAL({out_p},{out_s}))"
