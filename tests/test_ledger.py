"""The ledger of keyed state: any split of the events into batches, and a restart, end in the batch result."""

import datetime as dt

import numpy as np
import pytest

from quillboard.streaming import ledger as lg

DAY = dt.datetime(2024, 1, 1)


def events(seed, n=300, people=7):
    r = np.random.default_rng(seed)
    out = []
    for k in range(n):
        ts = DAY + dt.timedelta(hours=int(r.integers(0, 400)))
        role = ["resolution", "early", "input"][int(r.integers(0, 3))]
        out.append((int(r.integers(0, people)), k, ts, role, (ts + dt.timedelta(days=int(r.integers(0, 9)))).date() if k % 11 else None, float(k) / n, f"i{int(r.integers(0, 3))}" if k % 13 else None))
    return [*out, (99, n, DAY, "input", None, None, None), (98, n + 1, DAY, "early", None, 0.5, "x"), (97, n + 2, DAY, "resolution", DAY.date(), 0.7, "x")]


def plain(rows):
    out = set()
    for person in {e[0] for e in rows}:
        own = sorted((e for e in rows if e[0] == person), key=lambda e: (e[2], e[1]))
        res, early, inputs = ([e for e in own if e[3] == k] for k in ("resolution", "early", "input"))
        window = res[0][4] if res else None
        over = window is not None and res[-1][2] >= dt.datetime.combine(window, dt.time())
        call, p = ("fresh", res[-1][5]) if over else ("early", early[-1][5]) if early else (None, None)
        out.add((person, len(own), window, len({e[4] for e in res} - {None}), call, p, len(early) if over else 0, inputs[-1][6] if inputs else None))
    return out


def stream(spark, path, files):
    return spark.readStream.schema(lg.EVENT).option("maxFilesPerTrigger", files).parquet(path)


@pytest.mark.parametrize("parts", [1, 5])
def test_any_split(spark, parts, tmp_path):
    rows = events(parts)
    for k in range(parts):
        spark.createDataFrame(rows[k::parts], lg.EVENT).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    got = lg.keep_ledger(spark, stream(spark, f"{tmp_path}/in", 1), f"{tmp_path}/out")
    assert {tuple(r) for r in got.collect()} == plain(rows) and got.count() == len(plain(rows))


def test_a_restart_goes_on(spark, tmp_path):
    rows = events(9)
    spark.createDataFrame(rows[:150], lg.EVENT).repartition(2).write.parquet(f"{tmp_path}/in")
    first = lg.keep_ledger(spark, stream(spark, f"{tmp_path}/in", 1), f"{tmp_path}/out").collect()
    assert {tuple(r) for r in first} == plain(rows[:150])
    spark.createDataFrame(rows[150:], lg.EVENT).write.mode("append").parquet(f"{tmp_path}/in")
    again = lg.keep_ledger(spark, stream(spark, f"{tmp_path}/in", 3), f"{tmp_path}/out").collect()
    assert {tuple(r) for r in again} == plain(rows)
    # rows that stayed were not written again
    changes = spark.read.parquet(f"{tmp_path}/out/changes").where("person = 99").collect()
    assert [r["mark"] for r in changes] == [1]
