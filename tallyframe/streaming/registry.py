"""A registry of members as snapshots arrive: ids minted at first sight, spells closed when their value changes or their member stays away.

State is one map entry for each value that a member has had open and its last day, so it grows with the members that are present, not with what has been seen:
a timer closes a member's spell and forgets the member when the watermark says that it was absent for too long.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

#: State with timers needs this store: set spark.sql.streaming.stateStore.providerClass to it.
STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
SPELL = "id string, member string, value string, start_day date, end_day date, closed_by string"
DAY_MS = 86_400_000


def member_id(member: str) -> str:
    """An id that depends on the member's key alone, so that a restart, another split of files or a return after its state is forgotten mints the same."""
    return f"PER-{hashlib.sha1(member.encode()).hexdigest()[:12]}"


class Spells(StatefulProcessor):
    """Map state: 'open' -> (id, value, start, last day). Snapshots that are older than the last one seen are left out."""

    def __init__(self, absent_days: int):
        self.absent_days = absent_days

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.open = handle.getMapState("open", "slot string", "id string, value string, start_day date, last_day date")

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        out = []
        held = self.open.getValue(("spell",)) if self.open.containsKey(("spell",)) else None
        seen = pd.concat(list(rows)).sort_values(["day", "value"])
        for day, value in zip(seen["day"], seen["value"], strict=True):
            if held is not None and (day - held[3]).days > self.absent_days:
                out.append((held[0], key[0], held[1], held[2], held[3], "absence"))
                held = None
            if held is None:
                held = (member_id(key[0]), value, day, day)
            elif day >= held[3] and value != held[1]:
                out.append((held[0], key[0], held[1], held[2], day, "change"))
                held = (held[0], value, day, day)
            elif day > held[3]:
                held = (*held[:3], day)
        for at in self.handle.listTimers():
            self.handle.deleteTimer(at)
        if held is not None:
            self.open.updateValue(("spell",), held)
            self.handle.registerTimer(int(pd.Timestamp(held[3]).value // 1_000_000) + (self.absent_days + 1) * DAY_MS)
        yield frame(out)

    def handleExpiredTimer(self, key: tuple, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        held = self.open.getValue(("spell",)) if self.open.containsKey(("spell",)) else None
        self.open.clear()
        yield frame([(held[0], key[0], held[1], held[2], held[3], "absence")] if held is not None else [])

    def close(self) -> None:
        pass


def frame(rows: list[tuple]) -> pd.DataFrame:
    return pd.DataFrame(rows, columns=["id", "member", "value", "start_day", "end_day", "closed_by"])


def spells_of(snapshots: DataFrame, absent_days: int, late: str = "0 seconds") -> DataFrame:
    """Closed spells (id, member, value, start_day, end_day, closed_by) of a stream of snapshots (member, ts, value), one a member and day.

    A new value closes the spell on its own day ('change'); more than absent_days without a sight close it on the last day seen ('absence'), and the member's state is forgotten.
    """
    s = snapshots.withColumn("day", F.to_date("ts")).withWatermark("ts", late)
    return s.groupBy("member").transformWithStateInPandas(Spells(absent_days), SPELL, "Append", "EventTime")


def spells_at_once(snapshots: DataFrame, absent_days: int) -> DataFrame:
    """What spells_of() gives once all members have been absent: the same spells of a finished table, by windows."""
    w = Window.partitionBy("member").orderBy("day")
    s = snapshots.select("member", F.to_date("ts").alias("day"), "value").withColumn("before", F.lag("day").over(w)).withColumn("was", F.lag("value").over(w))
    gone = F.col("before").isNull() | (F.date_diff("day", "before") > absent_days)
    s = s.withColumn("stay", F.sum(gone.cast("int")).over(w)).withColumn("spell", F.sum((gone | (F.col("was") != F.col("value"))).cast("int")).over(w))
    spells = s.groupBy("member", "stay", "spell").agg(F.min("value").alias("value"), F.min("day").alias("start_day"), F.max("day").alias("last_day"))
    of_stay = Window.partitionBy("member", "stay").orderBy("spell")
    spells = spells.withColumn("next", F.lead("start_day").over(of_stay))
    name = F.concat(F.lit("PER-"), F.substring(F.sha1(F.col("member").cast("binary")), 1, 12))
    return spells.select(name.alias("id"), "member", "value", "start_day", F.coalesce("next", "last_day").alias("end_day"), F.when(F.col("next").isNotNull(), "change").otherwise("absence").alias("closed_by"))
