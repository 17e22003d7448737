"""Each query against its SQL in another engine, on the smallest tables."""

import math

import duckdb
import pytest

from quillboard.plans.catalog import ORACLES, QUERIES, WITHOUT_SQL

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 4) + 0.0
    if hasattr(v, "as_tuple"):
        return float(v)
    return v


def rows(names, data):
    order = sorted(range(len(names)), key=lambda k: names[k])
    return sorted((tuple(plain(r[k]) for k in order) for r in data), key=repr)


def test_every_query_has_sql():
    assert QUERIES.keys() == ORACLES.keys() | WITHOUT_SQL


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    df = QUERIES[name](spark, SF)
    got = rows(df.columns, df.collect())
    want_names = [d[0] for d in con.execute(ORACLES[name]).description]
    want = rows(want_names, con.execute(ORACLES[name]).fetchall())
    assert sorted(df.columns) == sorted(want_names)
    assert len(got) == len(want) > 0
    different = [(g, w) for g, w in zip(got, want, strict=True) if any(a != b and not (isinstance(a, float) and isinstance(b, (int, float)) and abs(a - b) < 2e-4) for a, b in zip(g, w, strict=True))]
    assert not different, different[:3]
