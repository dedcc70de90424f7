"""Every registered query of the library against its SQL in DuckDB, on the small tables."""

from __future__ import annotations

import os

import duckdb
import pytest

from tidewatch import registry

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return c


def value(x):
    if x is None or x != x:
        return None
    return round(float(x), 9) + 0.0 if isinstance(x, float) or type(x).__name__ == "Decimal" else str(x).removesuffix(" 00:00:00")


def rows(df):
    columns = sorted(df.columns)
    return columns, sorted(repr([value(x) for x in r]) for r in df[columns].astype(object).itertuples(index=False, name=None))


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_query_matches_sql(spark, con, name):
    got, want = registry.queries()[name](spark, SF).toPandas(), con.sql(registry.oracle_sql()[name]).df()
    assert rows(got) == rows(want)


def test_entry_points():
    import __spark_entry__ as e

    assert set(e.oracle_sql()) <= set(e.queries())
