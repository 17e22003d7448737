"""Operators that SQL can express, against it in another engine over whole tables."""

import duckdb
import pytest

pytest.importorskip("public_tokenizers")

from quillboard.llm.queries import ORACLES, QUERIES  # noqa: E402

SF = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_operator_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings"):
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    want = con.execute(ORACLES[name])
    names = [c[0] for c in want.description]
    df = QUERIES[name](spark, SF)
    assert sorted(df.columns) == sorted(names)
    got, rows = sorted(map(tuple, df.select(*names).collect()), key=repr), sorted(want.fetchall(), key=repr)
    assert len(got) == len(rows) > 0
    different = [(g, w) for g, w in zip(got, rows, strict=True) if g != w]
    assert not different, different[:3]
