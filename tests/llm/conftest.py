import math

import duckdb
import pytest

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def against_sql(spark):
    """Compares a query with its SQL on the smallest tables."""

    def compare(name):
        from tributary.llm import queries

        con = duckdb.connect()
        for t in ("documents", "benchmark", "labels", "conversations"):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{FOLDER}/{t}.parquet'")
        df = queries.JOBS[name](spark, FOLDER)
        want = con.execute(queries.SQL[name])
        columns = [d[0] for d in want.description]
        assert sorted(columns) == sorted(df.columns)
        cell = lambda v: round(v, 9) if isinstance(v, float) and math.isfinite(v) else v
        got = sorted(repr(tuple(map(cell, r))) for r in df.select(*columns).collect())
        assert got == sorted(repr(tuple(map(cell, r))) for r in want.fetchall())

    return compare
