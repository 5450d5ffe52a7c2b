"""Every registered query against its DuckDB oracle on the smallest tables."""

import os
import subprocess
import sys

import __spark_entry__ as E
from coursewise import catalog

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_every_query_has_an_oracle():
    assert set(catalog.ORACLES) == set(catalog.QUERIES) <= set(E.oracle_sql()) & set(E.queries())


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0 and "register_day" in df.columns


def test_oracles_match_sf0001():
    # own process: the checker builds its own session
    r = subprocess.run([sys.executable, os.path.join(ROOT, "tools", "check_oracles.py"), "/root/testdata/sf0.001",
                        *catalog.QUERIES],
                       capture_output=True, text=True, timeout=1800)
    last = [ln for ln in r.stdout.splitlines() if ln.startswith("mismatches:")]
    assert last == ["mismatches: 0"], r.stdout[-3000:]
