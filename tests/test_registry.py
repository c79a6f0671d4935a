"""Registered queries against their oracle SQL, on the smallest tables."""

import os

import pytest

from skyweft.plans import registry

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    import duckdb

    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in os.listdir(SF):
        if name.endswith(".parquet"):
            con.execute(f"CREATE VIEW {name[:-8]} AS SELECT * FROM '{SF}/{name}'")
    return con


def canonical(frame):
    frame = frame[sorted(frame.columns)].copy()
    for c in frame.columns:
        numeric = str(frame[c].dtype).lower().startswith(("float", "int"))
        frame[c] = frame[c].astype("float64").round(6) if numeric else frame[c].astype(str).replace({"None": "", "nan": "", "<NA>": ""})
    return frame.sort_values(list(frame.columns)).reset_index(drop=True)


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_oracle(spark, duck, name):
    got = canonical(registry.queries()[name](spark, SF).toPandas())
    want = canonical(duck.execute(registry.oracle_sql()[name]).df())
    assert list(got.columns) == list(want.columns)
    assert len(got) == len(want) > 0
    assert got.equals(want)


@pytest.mark.parametrize("name", sorted(set(registry.queries()) - set(registry.oracle_sql())))
def test_rows(spark, name):
    assert registry.queries()[name](spark, SF).count() > 0
