"""Every query that has SQL, on the smallest tables, against DuckDB."""

import re

import duckdb
import pytest

import __spark_entry__ as entry
from check_oracle import TABLES, canonical

SF = "/root/testdata/sf0.001"
NAMES = [n for n in entry.oracle_sql() if not re.match(r"op\d+_", n)]


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    c.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", NAMES)
def test_matches_sql(spark, con, name):
    ours = canonical(entry.queries()[name](spark, SF).toPandas())
    theirs = canonical(con.execute(entry.oracle_sql()[name]).df())
    assert list(ours.columns) == list(theirs.columns)
    assert len(ours) == len(theirs)
    assert ours.equals(theirs)


def test_entry(spark):
    rows = entry.entry(spark).toPandas()
    assert set(rows.flag) == {"observed", "missing"}
    for _, g in rows.sort_values("datetime").groupby("series"):
        assert (g.datetime.diff().dropna().dt.total_seconds() == 900).all()
