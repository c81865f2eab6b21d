import json
import time

import pytest
from pyspark.sql import functions as F

from framekeel.operators import windows
from framekeel.streaming import runner
from framekeel.streaming import windows as streams

SCHEMA = "session string, ts long, event_id long"


def arrive(spark, folder, ts, session="a"):
    """Add one file of events."""
    rows = [(session, t, t) for t in ts]
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(folder)
    time.sleep(0.05)


def stream(spark, folder, delay="0 seconds", files=1):
    rows = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", files).parquet(folder)
    return streams.with_lateness(windows.assign_event_time(rows), delay)


def counts(df):
    return streams.window_stats(df, "session", 60, F.count("*").alias("n"))


def drain(spark, df, base, name="out"):
    out = f"{base}/{name}"
    query = runner.to_files(df, out, f"{base}/{name}-checkpoint")
    query.awaitTermination()
    return spark.read.schema(df.schema).parquet(out), query


def test_late_rows_are_dropped(spark, tmp_path):
    folder = str(tmp_path / "in")
    for ts in ([10, 70], [500], [20, 505], [2000]):
        arrive(spark, folder, ts)
    closed, query = drain(spark, counts(stream(spark, folder)), tmp_path)
    got = sorted((r["window_start"], r["n"]) for r in closed.collect())
    assert got == [(0, 1), (60, 1), (480, 2)]
    dropped = sum(s["numRowsDroppedByWatermark"] for p in query.recentProgress for s in p["stateOperators"])
    assert dropped == 1


def test_delay_keeps_late_rows(spark, tmp_path):
    folder = str(tmp_path / "in")
    for ts in ([10, 70], [500], [20, 505], [2000]):
        arrive(spark, folder, ts)
    closed, _ = drain(spark, counts(stream(spark, folder, "10 minutes")), tmp_path)
    assert sorted((r["window_start"], r["n"]) for r in closed.collect()) == [(0, 2), (60, 1), (480, 2)]


def test_restart_goes_on_where_it_stopped(spark, tmp_path):
    folder = str(tmp_path / "in")
    parts = ([1, 2, 61], [62, 130], [131, 400], [900])
    for ts in parts[:2]:
        arrive(spark, folder, ts)
    drain(spark, counts(stream(spark, folder)), tmp_path, "stopped")
    for ts in parts[2:]:
        arrive(spark, folder, ts)
    restarted, _ = drain(spark, counts(stream(spark, folder)), tmp_path, "stopped")
    whole, _ = drain(spark, counts(stream(spark, folder)), tmp_path, "whole")
    assert sorted(map(tuple, restarted.collect())) == sorted(map(tuple, whole.collect()))
    assert whole.count() == 4


@pytest.mark.parametrize("merge", ["true", "false"])
def test_stream_sessions_equal_table_sessions(spark, tmp_path, merge):
    option = "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition"
    before = spark.conf.get(option)
    spark.conf.set(option, merge)
    try:
        folder = str(tmp_path / "in")
        arrive(spark, folder, [0, 119, 241, 361, 480])
        arrive(spark, folder, [0, 120, 239, 300], "b")
        end = 10_000
        table = windows.assign_event_time(spark.read.parquet(folder))
        arrive(spark, folder, [end], "end")
        closed, _ = drain(
            spark, streams.session_latest(stream(spark, folder, files=9), "session", 120, "event_id"), tmp_path
        )
    finally:
        spark.conf.set(option, before)
    expected = windows.sessions(table, "session", 120, "event_id")
    assert closed.columns == expected.columns
    assert sorted(map(tuple, closed.collect())) == sorted(map(tuple, expected.collect()))
    assert expected.count() == 5


def test_sliding_stream_equals_table(spark, tmp_path):
    folder = str(tmp_path / "in")
    arrive(spark, folder, [0, 30, 61, 299, 300, 420])
    table = windows.assign_event_time(spark.read.parquet(folder))
    arrive(spark, folder, [10_000], "end")
    stats = [F.count("event_id").alias("n"), F.sum("event_id").alias("total")]
    closed, _ = drain(
        spark, streams.window_stats(stream(spark, folder), "session", 300, *stats, slide_seconds=60), tmp_path
    )
    expected = windows.sliding_stats(table, "session", "event_id", 300, 60)
    columns = ["session", "window_start", "window_end", "n", "total"]
    got = closed.where("session = 'a'").select(*columns).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, expected.select(*columns).collect()))


def test_repeated_messages_count_once(spark, tmp_path):
    folder = str(tmp_path / "in")
    arrive(spark, folder, [5, 6])
    arrive(spark, folder, [6, 7])
    arrive(spark, folder, [1000])
    once = streams.drop_repeats(stream(spark, folder, "60 seconds"), "session", "ts")
    out, _ = drain(spark, once.select("session", "ts"), tmp_path)
    assert sorted(r["ts"] for r in out.collect()) == [5, 6, 7, 1000]


def test_replayed_batch_replaces_itself(spark, tmp_path):
    folder, out = str(tmp_path / "in"), str(tmp_path / "out")
    arrive(spark, folder, [1])
    arrive(spark, folder, [2])
    failed = []

    def write(batch, batch_id):
        batch.select("ts").write.mode("overwrite").parquet(runner.batch_path(out, batch_id))
        if batch_id == 1 and not failed:
            failed.append(batch_id)
            raise RuntimeError("lost after writing")

    def run():
        rows = stream(spark, folder)
        runner.each_batch(rows, write, str(tmp_path / "checkpoint")).awaitTermination()

    with pytest.raises(Exception, match="lost after writing"):
        run()
    run()
    assert failed == [1]
    assert sorted(r["ts"] for r in spark.read.parquet(out).collect()) == [1, 2]


def test_sliding_state_does_not_grow_with_the_keys(spark, tmp_path):
    source, schema = str(tmp_path / "in"), "event_time timestamp, session string, value decimal(10,2)"
    key = F.when(F.col("id") % 1001 != 0, F.concat(F.lit("s"), F.col("id") % 1001))
    value = F.when(F.col("id") % 5 != 0, F.col("id") - 2000)
    rows = spark.range(4004).select(
        F.timestamp_seconds(F.col("id") % 7 * 47).alias("event_time"), key.alias("session"), value.cast("decimal(10,2)").alias("value")
    )
    rows.coalesce(1).write.parquet(source)
    end = spark.range(1).selectExpr("timestamp_seconds(10000) event_time", "'end' session", "cast(1 as decimal(10,2)) value")
    end.coalesce(1).write.mode("append").parquet(source)
    timed = streams.with_lateness(spark.readStream.schema(schema).parquet(source))
    closed, query = drain(spark, streams.sliding_stats(timed, "session", "value", 300, 60), tmp_path)
    expected = windows.sliding_stats(rows, "session", "value", 300, 60).drop("mean")
    assert closed.dtypes == expected.dtypes and expected.count() > 5000
    got = closed.where("NOT session <=> 'end'").collect()
    assert sorted(map(repr, got)) == sorted(map(repr, expected.collect()))
    updated = [json.loads(p.json)["stateOperators"][0]["numRowsUpdated"] for p in query.recentProgress]
    assert sum(updated) <= 12 * streams.BUCKETS
