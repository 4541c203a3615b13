"""Streaming forms of the event operators: an extension, beyond what a batch pipeline needs.

Windows close by watermark, so state stays bounded by the lateness allowed; transitions keep one small row of state
for each member.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

EVENTS = "event_id long, ts timestamp, user_id long, event_type string, value double, props string"


def read_events(spark, path: str, files_each: int = 1) -> DataFrame:
    """A stream of the event files under a folder, a few of them in each batch."""
    return spark.readStream.schema(EVENTS).option("maxFilesPerTrigger", files_each).parquet(path)


def windowed_counts(events: DataFrame, size: str = "1 day", slide: str | None = None, late: str = "1 hour") -> DataFrame:
    """(start, event_type, n, total) for tumbling or sliding windows; later events than `late` are left out."""
    w = F.window("ts", size, slide) if slide else F.window("ts", size)
    return events.withWatermark("ts", late).groupBy(w.alias("w"), "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("total")).select(F.col("w.start").alias("start"), "event_type", "n", "total")


def sessions(events: DataFrame, gap: str = "30 minutes", late: str = "1 hour") -> DataFrame:
    """(user_id, start, end, n): runs of a user's events without a longer gap."""
    s = events.withWatermark("ts", late).groupBy(F.session_window("ts", gap).alias("w"), "user_id").agg(F.count("*").alias("n"))
    return s.select("user_id", F.col("w.start").alias("start"), F.col("w.end").alias("end"), "n")


def deduplicated(events: DataFrame, late: str = "1 hour") -> DataFrame:
    return events.withWatermark("ts", late).dropDuplicatesWithinWatermark(["event_id"])


def transitions(events: DataFrame) -> DataFrame:
    """(user_id, bloc_from, bloc_to, at) whenever a user's event type changes.

    Within a batch events are taken in order of (ts, event_id); one that is older than what the state has seen is left out.
    """

    def step(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        before, seen = state.get if state.exists else (None, None)
        rows = pd.concat(list(frames)).sort_values(["ts", "event_id"])
        out = []
        for ts, kind in zip(rows["ts"], rows["event_type"], strict=True):
            at = ts.value // 1000
            if seen is not None and at < seen:
                continue
            if before is not None and kind != before:
                out.append((key[0], before, kind, ts))
            before, seen = kind, at
        state.update((before, seen))
        yield pd.DataFrame(out, columns=["user_id", "bloc_from", "bloc_to", "at"])

    return events.groupBy("user_id").applyInPandasWithState(step, "user_id long, bloc_from string, bloc_to string, at timestamp", "before string, seen long", "append", GroupStateTimeout.NoTimeout)
