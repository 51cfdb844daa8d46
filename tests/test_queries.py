"""Every query with SQL against DuckDB on the smallest tables."""

from __future__ import annotations

import math
import os
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry

DATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not Path(DATA).exists(), reason="no tables")


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for p in Path(DATA).glob("*.parquet"):
        c.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM read_parquet('{p}{'/*' if p.is_dir() else ''}')")
    return c


def plain(v):
    if v is None or isinstance(v, float) and math.isnan(v):
        return ""
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, (int, float)) or type(v).__name__ == "Decimal":
        return f"{float(v):.8g}"
    return str(v)


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_equals_sql(spark, duck, name):
    got = entry.queries()[name](spark, DATA)
    cols = sorted(got.columns)
    want = duck.execute(f"SELECT {', '.join(f'\"{c}\"' for c in cols)} FROM ({entry.oracle_sql()[name]})").fetchall()
    have = [tuple(r) for r in got.select(*cols).collect()]
    assert sorted(tuple(map(plain, r)) for r in have) == sorted(tuple(map(plain, r)) for r in want)


@pytest.mark.parametrize("name", ["emi_kernel", "refocus_kernel"])
def test_runs(spark, name):
    assert entry.queries()[name](spark, DATA).count() > 0


def test_entry_plans(spark):
    assert "level" in entry.entry(spark).columns
