"""The queries with SQL against DuckDB."""

import duckdb
import pytest

from conftest import SF_SMALL
from intervalflow.llm import queries


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_query_matches_oracle(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    got, want = queries.QUERIES[name](spark, SF_SMALL).toPandas(), con.execute(queries.ORACLE[name]).df()
    assert sorted(got.columns) == sorted(want.columns) and len(got) == len(want)
    cols = sorted(got.columns)

    def plain(v):
        return "" if v is None else str(int(v)) if isinstance(v, float) and v == int(v) else str(v)

    def rows(df):
        clean = df[cols].astype(object).where(df[cols].notna(), None)
        return sorted("|".join(map(plain, r)) for r in clean.itertuples(index=False, name=None))
    assert rows(got) == rows(want)
