"""Every query against its SQL twin, on the smallest tables."""

import math

import duckdb
import pytest

from gazetta import queries

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents labels".split()


@pytest.fixture(scope="module")
def engine():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def rows(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def plain(x):
        if x is None or isinstance(x, float) and math.isnan(x):
            return ""
        return x if isinstance(x, str) else round(float(x), 5)

    return sorted([tuple(plain(r[i]) for i in order) for r in data], key=str)


@pytest.mark.parametrize("name", [k for k in queries.ORACLES if k != "match_chains"])
def test_against_sql(spark, engine, name):
    df = queries.QUERIES[name](spark, SF)
    want = engine.execute(queries.ORACLES[name])
    columns = [c[0] for c in want.description]
    assert sorted(df.columns) == sorted(columns)
    assert rows(df.columns, df.collect()) == rows(columns, want.fetchall())
