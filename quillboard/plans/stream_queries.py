"""Queries that Structured Streaming answers, each with the SQL of the whole table."""

from __future__ import annotations

from pyspark.sql import functions as F

from quillboard.plans.registry import query
from quillboard.streaming.ledger import keep_ledger


def ledger_events(events):
    """Events as the ledger takes them: purchases are resolutions, clicks early calls, all others inputs."""
    kind, day = F.col("event_type"), F.to_date("ts")
    role = F.when(kind == "purchase", "resolution").when(kind == "click", "early").otherwise("input")
    return events.select(
        F.col("user_id").alias("person"), F.col("event_id").alias("id"), F.col("ts").cast("timestamp").alias("ts"), role.alias("role"),
        F.date_add(day, F.get_json_object("props", "$.k").cast("int")).alias("deadline"), (F.col("value") / 500).alias("p"), F.md5("props").alias("input"),
    )


@query(
    """with e as (select user_id person, event_id id, ts, event_type kind, ts::date + (props->>'$.k')::int deadline, value / 500 p, md5(props) input from events),
 r as (select person, arg_min(deadline, (ts, id)) deadline, count(distinct deadline) windows, max(ts) last_ts, arg_max(p, (ts, id)) last_p from e where kind = 'purchase' group by person), c as (select person, count(*) k, arg_max(p, (ts, id)) p from e where kind = 'click' group by person), i as (select person, arg_max(input, (ts, id)) input from e where kind not in ('purchase', 'click') group by person),
 a as (select person, count(*) n from e group by person), x as (select a.person, n, r.deadline, coalesce(windows, 0) windows, coalesce(last_ts >= r.deadline, false) over_, last_p, c.k, c.p early_p, input from a left join r using (person) left join c using (person) left join i using (person))
 select person, n, deadline, windows, case when over_ then 'fresh' when k > 0 then 'early' end call, round(case when over_ then last_p else early_p end, 6) p, case when over_ then coalesce(k, 0) else 0 end replaced, input digest from x"""
)
def stream_ledger(spark, d):
    """Per person: the window that the first resolution fixed, the call that stands, early calls replaced, digest of the last input; by keyed state."""
    path = f"{d}/events.parquet"
    folder, _, name = path.rpartition("/")
    stream = spark.readStream.schema(spark.read.parquet(path).schema)
    # a single file is read out of its folder, a table of several as the folder that it is
    one = spark.read.format("binaryFile").load(path).select("path").limit(2).collect()
    whole = len(one) == 1 and one[0]["path"].endswith(f"/{name}")
    events = stream.option("pathGlobFilter", name).parquet(folder) if whole else stream.parquet(path)
    got = keep_ledger(spark, ledger_events(events))
    return got.withColumn("p", F.round("p", 6))
