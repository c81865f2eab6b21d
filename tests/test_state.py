"""Open windows read from checkpoints, and jobs that are replaced."""

import json
import time

import pytest
from pyspark.sql import functions as F

from framekeel.config import HealthJobConfig
from framekeel.sources.messages import read_messages
from framekeel.streaming import jobs, runner, state
from framekeel.streaming import windows as streams

SCHEMA = "user string, event_time timestamp, value double"


def rows(spark, *found):
    return spark.createDataFrame(list(found), "user string, at long, value double").select(
        "user", F.timestamp_seconds("at").alias("event_time"), "value"
    )


def stats(spark, inbox, size, *more):
    stream = streams.with_lateness(spark.readStream.schema(SCHEMA).parquet(inbox))
    return streams.window_stats(stream, "user", size, F.sum("value").alias("a"), F.avg("value").alias("b"), *more)


def test_open_windows_of_a_checkpoint(spark, tmp_path):
    inbox, checkpoint = str(tmp_path / "in"), str(tmp_path / "cp")
    rows(spark, ("a", 10, 1.0), ("a", 70, 2.0), ("a", 119, 4.0), (None, 115, None), ("b", 65, 8.0)).write.parquet(inbox)
    runner.to_files(stats(spark, inbox, 60), str(tmp_path / "out"), checkpoint).awaitTermination()
    # The first window is closed; the watermark stands at 119.
    held = state.open_windows(spark, checkpoint, "total", "sum", "count").collect()
    assert {tuple(r) for r in held} == {("a", 60, 120, 6.0, 6.0, 2), (None, 60, 120, None, 0.0, 0), ("b", 60, 120, 8.0, 8.0, 1)}
    with pytest.raises(ValueError, match="3 values"):
        state.open_windows(spark, checkpoint, "total")
    # Later rows close them and open others.
    rows(spark, ("b", 500, 1.0)).write.mode("append").parquet(inbox)
    runner.to_files(stats(spark, inbox, 60), str(tmp_path / "out"), checkpoint).awaitTermination()
    held = state.open_windows(spark, checkpoint, "total", "sum", "count").collect()
    assert [tuple(r) for r in held] == [("b", 480, 540, 1.0, 1.0, 1)]


def test_nothing_is_open_after_an_empty_stream(spark, tmp_path):
    inbox, checkpoint = str(tmp_path / "in"), str(tmp_path / "cp")
    rows(spark, ("a", 10, 1.0)).write.parquet(inbox)
    runner.to_files(stats(spark, inbox, 60).where("false"), str(tmp_path / "out"), checkpoint).awaitTermination()
    assert {r.user for r in state.open_windows(spark, checkpoint, "t", "s", "c").collect()} <= {"a"}


def test_open_sessions_of_a_checkpoint(spark, tmp_path):
    inbox, checkpoint = str(tmp_path / "in"), str(tmp_path / "cp")
    rows(spark, ("a", 10, 1.0), ("a", 200, 2.0), ("b", 190, 8.0), ("b", 195, 4.0)).write.parquet(inbox)
    stream = streams.with_lateness(spark.readStream.schema(SCHEMA).parquet(inbox))
    runner.to_files(streams.session_latest(stream, "user", 60, "value"), str(tmp_path / "out"), checkpoint).awaitTermination()
    held = state.open_sessions(spark, checkpoint, "n_rows", "latest")
    found = held.selectExpr("user", "unix_seconds(session_start)", "unix_seconds(session_end)", "n_rows", "latest.value").collect()
    assert {tuple(r) for r in found} == {("a", 200, 260, 1, 2.0), ("b", 190, 255, 2, 4.0)}


def test_other_options_and_columns_are_refused(spark, tmp_path):
    checkpoint = str(tmp_path / "cp")
    df = spark.range(1).selectExpr("id", "'x' AS name")
    assert state.check_options(df, checkpoint, {"gap": 120}) is False
    state.keep_options(df, checkpoint, {"gap": 120, "none": None})
    state.keep_options(df, checkpoint, {"none": None, "gap": 120})
    with pytest.raises(state.ChangedJob, match="option gap is 60, was 120.*") as problem:
        state.keep_options(df, checkpoint, {"gap": 60, "none": None})
    assert "none" not in str(problem.value)
    with pytest.raises(state.ChangedJob, match="column id is int, was bigint; column name is missing, was string"):
        state.keep_options(df.selectExpr("CAST(id AS INT) AS id"), checkpoint, {"gap": 120, "none": None})
    with pytest.raises(state.ChangedJob, match="option period is 5, was missing"):
        state.check_options(df, checkpoint, {"gap": 120, "none": None, "period": 5})
    # What was refused has changed nothing.
    assert state.check_options(df, checkpoint, {"gap": 120, "none": None}) is True


def test_jobs_refuse_another_gap(spark, tmp_path):
    inbox = tmp_path / "in"
    inbox.mkdir()
    lines = [{"metadata": {"ts": t, "session": "a", "datesegment": "2021/01/01", "device_id": 1}} for t in (0, 59, 900)]
    (inbox / "1.txt").write_text("\n".join(map(json.dumps, lines)))
    base = {"bucket": "b", "base_path": "p", "module": "m", "checkpoint": str(tmp_path / "cp")}
    before, after = HealthJobConfig(**base), HealthJobConfig(**base, window_period_seconds=30)
    out = str(tmp_path / "out")
    jobs.request_renders(read_messages(spark, str(inbox), fmt="text"), before, out).awaitTermination()
    assert spark.read.parquet(out).count() == 1
    with pytest.raises(state.ChangedJob, match="option session_gap_seconds is 60, was 120"):
        jobs.request_renders(read_messages(spark, str(inbox), fmt="text"), after, out)
    # As before, the job goes on from its state: the session of the last row closes once.
    (inbox / "2.txt").write_text(json.dumps({"metadata": {**lines[0]["metadata"], "ts": 5000}}))
    jobs.request_renders(read_messages(spark, str(inbox), fmt="text"), before, out).awaitTermination()
    sent = [json.loads(r["value"])["metadata"]["ts"] for r in spark.read.parquet(out).collect()]
    assert sorted(sent) == [59, 900]


def test_a_refused_job_leaves_the_running_one(spark, tmp_path):
    inbox, checkpoint, out = (str(tmp_path / n) for n in ("in", "cp", "out"))
    rows(spark, ("a", 10, 1.0), ("a", 70, 2.0)).write.parquet(inbox)
    often = {"processingTime": "200 milliseconds"}

    def start(size):
        df = stats(spark, inbox, size)
        state.keep_options(df, checkpoint, {"size": size})
        return runner.to_files(df, out, checkpoint, trigger=often)

    running = start(60)
    try:
        running.processAllAvailable()
        with pytest.raises(state.ChangedJob, match="size is 30, was 60"):
            state.replace(running, stats(spark, inbox, 30), checkpoint, {"size": 30}, lambda: start(30))
        assert running.isActive
        old, running = running, state.replace(running, stats(spark, inbox, 60), checkpoint, {"size": 60}, lambda: start(60))
        assert not old.isActive and running.isActive
        rows(spark, ("a", 500, 4.0)).write.mode("append").parquet(inbox)
        deadline = time.time() + 60
        found = []
        while len(found) < 2 and time.time() < deadline:
            running.processAllAvailable()
            found = [(r.window_start, r.a) for r in spark.read.parquet(out).collect()]
        assert sorted(found) == [(0, 1.0), (60, 2.0)]
    finally:
        running.stop()
