"""Every query against its SQL, on the smallest tables; with a wrong row the comparison fails."""

import duckdb
import pytest

import __spark_entry__ as entry
from driftline.plans.oracles import ORACLES
from driftline.plans.queries import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def db():
    c = duckdb.connect()
    for t in ("events", "part"):
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return c


def rows(names, found):
    order = sorted(range(len(names)), key=lambda k: names[k])
    clean = lambda v: round(v, 5) + 0.0 if isinstance(v, float) else v
    return sorted((tuple(clean(r[k]) for k in order) for r in found), key=repr)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, db, name):
    df, sql = QUERIES[name](spark, SF), db.sql(ORACLES[name])
    assert sorted(df.columns) == sorted(sql.columns)
    got, want = rows(df.columns, df.collect()), rows(sql.columns, sql.fetchall())
    assert got == want
    assert got and got[1:] != want


def test_entry(spark):
    assert entry.entry(spark).count() > 0
    assert {"op4_exact_dedup", "pipeline"} <= set(entry.queries()) or not entry.HAS_LLM
