"""Every registered query against its DuckDB oracle on the smallest scale factor."""

import hashlib

import duckdb
import pytest

from conftest import SF_SMALL
import __spark_entry__ as E
from intervalflow.plans.queries import QUERIES

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


def _rows(df):
    cols = sorted(df.columns)

    def norm(v):
        if v is None or (isinstance(v, float) and v != v):
            return "NULL"
        if hasattr(v, "to_pydatetime"):
            v = v.to_pydatetime()
        return v.isoformat() if hasattr(v, "isoformat") else repr(v)
    return sorted("|".join(norm(x) for x in r) for r in df[cols].itertuples(index=False, name=None))


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    got = _rows(E.queries()[name](spark, SF_SMALL).toPandas())
    want = _rows(con.execute(E.oracle_sql()[name]).df())
    assert len(got) == len(want)
    assert hashlib.sha256("\n".join(got).encode()).digest() == hashlib.sha256("\n".join(want).encode()).digest()


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0 and "cost" in df.columns


@pytest.mark.parametrize("name", ["rate_asof_cost", "day_report_demand", "active_tariffs", "scalar_codec",
                                  "missing_intervals", "resume_window"])
def test_query_results_do_not_depend_on_session_zone(spark, name):
    utc = _rows(E.queries()[name](spark, SF_SMALL).toPandas())
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        ny = _rows(E.queries()[name](spark, SF_SMALL).toPandas())
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert utc == ny
