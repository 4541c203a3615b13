"""Streaming forms agree with their batch counterparts."""

from pyspark.sql import functions as F

from tallyframe.operators import spells as S
from tallyframe.streaming import events as E


def run(df, name, mode, tmp_path):
    q = df.writeStream.format("memory").queryName(name).outputMode(mode).option("checkpointLocation", str(tmp_path / name)).trigger(availableNow=True).start()
    q.awaitTermination(120)
    assert q.exception() is None
    return df.sparkSession.table(name)


def split_by_time(spark, sf, path):
    e = spark.read.parquet(f"{sf}/events.parquet")
    for at, (lo, hi) in enumerate((("2024-01-01", "2024-01-12"), ("2024-01-12", "2024-01-22"), ("2024-01-22", "2025-01-01"))):
        e.where((F.col("ts") >= lo) & (F.col("ts") < hi)).coalesce(1).write.mode("append").parquet(str(path))
    return e


def test_windows(spark, sf, tmp_path):
    e = split_by_time(spark, sf, tmp_path / "in")
    got = run(E.windowed_counts(E.read_events(spark, str(tmp_path / "in"), 10)), "windows", "complete", tmp_path)
    want = e.groupBy(F.date_trunc("day", "ts").alias("start"), "event_type").agg(F.count("*").alias("n"))
    assert sorted(map(tuple, got.select("start", "event_type", "n").collect())) == sorted(map(tuple, want.collect()))


def test_transitions(spark, sf, tmp_path):
    e = split_by_time(spark, sf, tmp_path / "in")
    got = run(E.transitions(E.read_events(spark, str(tmp_path / "in"), 10)), "moves", "append", tmp_path)
    runs = S.runs(e.select(F.col("user_id").alias("member"), F.col("event_type").alias("bloc"), "ts", "event_id"), "member", "bloc", ["ts", "event_id"])
    want = S.transitions(runs)
    assert sorted(map(tuple, got.select("user_id", "bloc_from", "bloc_to").collect())) == sorted(map(tuple, want.collect()))


def test_sessions_and_duplicates(spark, sf, tmp_path):
    split_by_time(spark, sf, tmp_path / "in")
    stream = E.read_events(spark, str(tmp_path / "in"), 10)
    n = spark.read.parquet(f"{sf}/events.parquet").count()
    assert run(E.sessions(stream), "sessions", "complete", tmp_path).agg(F.sum("n")).first()[0] == n
    assert run(E.deduplicated(stream.union(E.read_events(spark, str(tmp_path / "in"), 10))), "once", "append", tmp_path).count() == n
