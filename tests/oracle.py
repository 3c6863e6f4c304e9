"""Compare a query with its SQL on the same tables."""

import os

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def connect(sf_dir=SF_DIR):
    connection = duckdb.connect()
    for t in TABLES:
        connection.sql(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return connection


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted([tuple(repr(r[i]) if isinstance(r[i], float) else str(r[i]) for i in order) for r in rows])


def assert_same(df, sql, sf_dir=SF_DIR):
    want = connect(sf_dir).sql(sql)
    assert sorted(df.columns) == sorted(want.columns)
    assert rows_of(df.columns, df.collect()) == rows_of(want.columns, want.fetchall())
