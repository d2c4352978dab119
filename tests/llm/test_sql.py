"""Queries against their SQL, on the smallest tables and on rows of every odd kind."""

import duckdb
import pytest

from driftline.llm.queries import ORACLE_SQL, QUERIES

SF = "/root/testdata/sf0.001"


def rows(names, found):
    order = sorted(range(len(names)), key=lambda k: names[k])
    clean = lambda v: round(v, 4) + 0.0 if isinstance(v, float) else v
    return sorted((tuple(clean(r[k]) for k in order) for r in found), key=repr)


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_sql(spark, name):
    db = duckdb.connect()
    for t in ("documents", "pages", "labels", "embeddings", "benchmark"):
        db.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    df, sql = QUERIES[name](spark, SF), db.sql(ORACLE_SQL[name])
    assert sorted(df.columns) == sorted(sql.columns)
    assert rows(df.columns, df.collect()) == rows(sql.columns, sql.fetchall())
