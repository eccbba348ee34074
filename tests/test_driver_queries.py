"""Every registered query against its DuckDB oracle on the smallest tables."""

import math

import duckdb
import pytest

import __spark_entry__ as entry_module
from revlens.plans import catalog as E

SF_DIR = "/root/testdata/sf0.001"
TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_DIR}/{t}.parquet')")
    return c


def _canon(cols, data):
    order = sorted(range(len(cols)), key=lambda i: cols[i])

    def norm(v):
        if isinstance(v, float):
            return "nan" if math.isnan(v) else round(v, 6)
        return v
    out = [tuple(norm(r[i]) for i in order) for r in data]
    return sorted(out, key=lambda r: tuple(str(x) for x in r))


def test_every_query_has_an_oracle():
    assert set(E.oracle_sql()) == set(E.queries())


@pytest.mark.parametrize("name", sorted(E.queries()))
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF_DIR)
    got = _canon(df.columns, [tuple(r) for r in df.collect()])
    rel = con.sql(E.oracle_sql()[name])
    want = _canon(rel.columns, rel.fetchall())
    assert sorted(df.columns) == sorted(rel.columns)
    assert len(got) == len(want)
    assert got == want


def test_entry_smoke(spark):
    df = entry_module.entry(spark)
    assert df.columns == ["item_id", "title", "avg_rating", "n_ratings"]
    assert df.count() > 0
