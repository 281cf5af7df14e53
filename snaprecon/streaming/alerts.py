"""W2/W3 as a stream: fallback streaks and unexpected empty days, as soon as a day is over.

One state per base: the volumes and fallback marks of its open days, the last
days' volumes, and the streak that is running. An event-time timer stands at
the end of the next day to be judged, so a day without any event is judged,
too, once the watermark has passed it. Every day is judged once, in order;
what a day's rows add up to is all that is kept of them.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

RESULT = "base string, day date, volume bigint, trailing_avg double, alert boolean, fallback boolean, streak int"
_DAY_MS = 86_400_000


def _end_ms(day: int) -> int:
    """The first millisecond after day number ``day``."""
    return (day + 1) * _DAY_MS


class DayClose(StatefulProcessor):
    """Judges a base's days in order; rows are (base, day, volume, fallback), any number a day."""

    def __init__(self, trailing: int = 7):
        self.trailing = trailing

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.days = handle.getMapState("days", "day int", "volume bigint, fallback boolean")
        self.past = handle.getValueState("past", "next_day int, volumes array<bigint>, streak int")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        first = None
        for frame in rows:
            for day, part in frame.groupby("day"):
                volume, fallback = int(part["volume"].sum()), bool(part["fallback"].any())
                if self.days.containsKey((int(day),)):
                    held = self.days.getValue((int(day),))
                    volume, fallback = volume + held[0], fallback or held[1]
                self.days.updateValue((int(day),), (volume, fallback))
                first = int(day) if first is None else min(first, int(day))
        if first is not None:
            held = self.past.get() if self.past.exists() else None
            if held is None or (not held[1] and first < held[0]):
                # nothing is judged yet: the base starts with its first day
                if held is not None:
                    self.handle.deleteTimer(_end_ms(held[0]))
                self.past.update((first, [], 0))
                self.handle.registerTimer(_end_ms(first))
        yield from ()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        day, volumes, streak = self.past.get()
        volumes, out = list(volumes), []
        while _end_ms(day) <= timerValues.getCurrentWatermarkInMs():
            held = self.days.getValue((day,)) if self.days.containsKey((day,)) else None
            volume, fallback = (int(held[0]), bool(held[1])) if held is not None else (0, False)
            if held is not None:
                self.days.removeKey((day,))
            before = volumes[-self.trailing :]
            average = sum(before) / len(before) if before else None
            streak = streak + 1 if fallback else 0
            out.append((key[0], dt.date(1970, 1, 1) + dt.timedelta(day), volume, None if average is None else round(average, 6), volume == 0 and bool(average), fallback, streak))
            volumes = [*before, volume][-self.trailing :]
            day += 1
        self.past.update((day, volumes, streak))
        self.handle.registerTimer(_end_ms(day))
        if out:
            yield pd.DataFrame(out, columns=["base", "day", "volume", "trailing_avg", "alert", "fallback", "streak"])

    def close(self) -> None:
        pass


def day_alerts(events: DataFrame, delay: str, trailing: int = 7) -> DataFrame:
    """Streaming frame of judged days (:data:`RESULT`) of runs (base, ts, total_records, source_mode).

    A base's days run from its first one to the watermark (greatest event time
    less ``delay``). A day's volume is what its runs extracted; it alerts when
    it is nought after ``trailing`` days that were not. streak: consecutive
    days with a fallback run, up to this one. Rows behind the watermark are
    dropped by Spark. Needs the RocksDB state store.
    """
    rows = events.withWatermark("ts", delay).select(
        "ts", "base", F.unix_date(F.to_date("ts")).alias("day"), F.coalesce("total_records", F.lit(0)).cast("bigint").alias("volume"), F.coalesce(F.col("source_mode") != "api", F.lit(False)).alias("fallback")
    )
    return rows.where("base is not null and ts is not null").groupBy("base").transformWithStateInPandas(
        statefulProcessor=DayClose(trailing), outputStructType=RESULT, outputMode="append", timeMode="eventTime"
    )


def drain(events: DataFrame, sink: str, delay: str, trailing: int = 7, partitions: int = 8) -> None:
    """Judge what days the events that have arrived close (availableNow); the judged days are appended to ``sink`` once each.

    ``partitions`` is the number of state partitions, fixed with the first
    call: there is one state a base, and bases are few.
    """
    conf = events.sparkSession.conf
    own = {"spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider", "spark.sql.shuffle.partitions": str(partitions)}
    before = {name: conf.get(name) for name in own}
    try:
        for name, value in own.items():
            conf.set(name, value)
        query = day_alerts(events, delay, trailing).writeStream.format("parquet").option("path", sink).option("checkpointLocation", f"{sink}.checkpoint").outputMode("append").trigger(availableNow=True).start()
        query.awaitTermination()
    finally:
        for name, value in before.items():
            conf.set(name, value)
