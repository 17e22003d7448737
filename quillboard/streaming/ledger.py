"""A ledger of forecasts kept by keyed state: windows that the first resolution fixes, early calls that fresh ones replace.

Each person's state is what their events add up to whatever the order in which batches
bring them: the first resolution in time, the last one, the last early call, the last input.
So a replay in any split of batches ends in the same ledger. A batch that changes what is
published of a person writes the old row with -1 and the new one with +1; a row whose
marks add up to one stands. Nothing is written for a person whose digest stays.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, Row, SparkSession, functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from quillboard.sources.shared import shared_folder

PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
HELD = "n long, resolutions long, early_calls long, first_ts long, first_id long, window date, last_ts long, last_id long, last_p double, call_ts long, call_id long, call_p double, input_ts long, input_id long, input string"
PUBLISHED = "person long, n long, deadline date, windows long, call string, p double, replaced long, digest string"
HELD_NAMES, PUBLISHED_NAMES = ([c.split()[0] for c in kind.split(", ")] for kind in (HELD, PUBLISHED))
EVENT = "person long, id long, ts timestamp, role string, deadline date, p double, input string"


class Ledger(StatefulProcessor):
    """State of a person: one row of firsts and lasts, the windows that resolutions named, and what is published."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.held = handle.getValueState("held", HELD)
        self.windows = handle.getMapState("windows", "deadline date", "n long")
        self.shown = handle.getValueState("shown", PUBLISHED)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        old = self.held.get()
        s = dict(zip(HELD_NAMES, old, strict=True)) if old else dict.fromkeys(HELD_NAMES) | {"n": 0, "resolutions": 0, "early_calls": 0}
        named = set()
        for r in rows:
            at = (r.ts_us, r.id)
            s["n"] += 1
            if r.role == "resolution":
                s["resolutions"] += 1
                named.add(r.deadline)
                if s["first_ts"] is None or at < (s["first_ts"], s["first_id"]):
                    s |= {"first_ts": at[0], "first_id": at[1], "window": r.deadline}
                if s["last_ts"] is None or at > (s["last_ts"], s["last_id"]):
                    s |= {"last_ts": at[0], "last_id": at[1], "last_p": r.p}
            elif r.role == "early":
                s["early_calls"] += 1
                if s["call_ts"] is None or at > (s["call_ts"], s["call_id"]):
                    s |= {"call_ts": at[0], "call_id": at[1], "call_p": r.p}
            elif s["input_ts"] is None or at > (s["input_ts"], s["input_id"]):
                s |= {"input_ts": at[0], "input_id": at[1], "input": r.input}
        for day in named:
            if day is not None and not self.windows.containsKey((day,)):
                self.windows.updateValue((day,), (1,))
        self.held.update(tuple(s[c] for c in HELD_NAMES))
        new = self.published(key[0], s)
        before = self.shown.get()
        if before is not None and tuple(before) == new:
            return
        self.shown.update(new)
        if before is not None:
            yield Row(**dict(zip(PUBLISHED_NAMES, before, strict=True)), mark=-1)
        yield Row(**dict(zip(PUBLISHED_NAMES, new, strict=True)), mark=1)

    def published(self, person: int, s: dict) -> tuple:
        """The row of a person: the last resolution counts once the frozen window is over, till then the last early call."""
        import datetime as dt

        over = s["window"] is not None and s["last_ts"] >= int((s["window"] - dt.date(1970, 1, 1)).total_seconds()) * 1_000_000
        call, p = ("fresh", s["last_p"]) if over else ("early", s["call_p"]) if s["early_calls"] else (None, None)
        windows = sum(1 for _ in self.windows.keys()) if s["resolutions"] else 0
        return person, s["n"], s["window"], windows, call, p, s["early_calls"] if over else 0, s["input"]

    def close(self) -> None:
        pass


def ledger_changes(events: DataFrame) -> DataFrame:
    """The published rows of a stream of events (EVENT) with their marks: -1 for a row that no longer stands, 1 for a new one."""
    keyed = events.withColumn("ts_us", F.unix_micros("ts")).groupBy("person")
    return keyed.transformWithState(Ledger(), f"{PUBLISHED}, mark int", "Update", "None")


def standing(changes: DataFrame) -> DataFrame:
    """The rows whose marks add up to one."""
    names = [c for c in changes.columns if c != "mark"]
    return changes.groupBy(*names).agg(F.sum("mark").alias("marks")).where("marks > 0").select(names)


def keep_ledger(spark: SparkSession, events: DataFrame, folder: str | None = None) -> DataFrame:
    """Run a stream of events to its end and give the ledger; started again with the same folder it goes on from its state.

    Changes are written by batch number, so a batch that runs again counts once.
    """
    folder = folder or shared_folder(spark, "ledger")
    held = spark.conf.get("spark.sql.streaming.stateStore.providerClass", None)
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", PROVIDER)
    try:

        def write(batch: DataFrame, number: int) -> None:
            batch.write.mode("overwrite").parquet(f"{folder}/changes/batch={number}")

        query = ledger_changes(events).writeStream.foreachBatch(write).outputMode("update").option("checkpointLocation", f"{folder}/state").trigger(availableNow=True).start()
        query.awaitTermination()
    finally:
        if held is None:
            spark.conf.unset("spark.sql.streaming.stateStore.providerClass")
        else:
            spark.conf.set("spark.sql.streaming.stateStore.providerClass", held)
    changes = spark.read.schema(f"{PUBLISHED}, mark int, batch int").parquet(f"{folder}/changes")
    return standing(changes.drop("batch"))
