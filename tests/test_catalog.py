"""Every query of the catalog against its SQL in a second engine."""

import duckdb
import pytest

from tributary.plans import catalog

FOLDER = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
JOBS, SQL = catalog.jobs(), catalog.sql_texts()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("SET timezone = 'UTC'")
    for name in TABLES.split():
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    return con


def normal(columns, rows):
    order = sorted(range(len(columns)), key=columns.__getitem__)

    def cell(v):
        return round(v, 6) if isinstance(v, float) else v

    return sorted(repr(tuple(cell(r[i]) for i in order)) for r in rows)


@pytest.mark.parametrize("name", sorted(JOBS))
def test_query(spark, duck, name):
    df = JOBS[name](spark, FOLDER)
    got = normal(df.columns, df.collect())
    cursor = duck.execute(SQL[name])
    columns = [d[0] for d in cursor.description]
    assert sorted(columns) == sorted(df.columns)
    assert got == normal(columns, cursor.fetchall())


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
