"""Chained aggregations, the message log, late rows, joins of streams, models kept by workers."""

import json

import pytest
from pyspark.sql import functions as F

from framekeel.config import HealthJobConfig
from framekeel.operators import health, windows
from framekeel.operators.models import KEPT, _held, held
from framekeel.operators.scoring import score_frames
from framekeel.sources import log
from framekeel.sources.messages import read_messages
from framekeel.streaming import jobs, joins, late, runner, trends
from framekeel.streaming import windows as streams

DETECTION = "session string, ts long, health_weight double, health_score double"


def drain(spark, df, base):
    query = runner.to_files(df, f"{base}/out", f"{base}/checkpoint")
    query.awaitTermination()
    return spark.read.schema(df.schema).parquet(f"{base}/out"), query


# --- health trends -------------------------------------------------------------------------------


def points():
    rows = []
    for k, ts in enumerate([0, 0, 1, 59, 60, 61, 200, 299, 300, 301, 480, 1000]):
        rows.append(("a", ts, [1.0, -0.5, 0.0, None][k % 4], [0.9, -0.4, 0.0, None][k % 4]))
    return rows + [("b", 70, 1.0, 0.5), ("b", 130, -0.5, -0.25), ("b", 131, 1.0, float("nan"))]


def rounded(rows):
    return sorted(tuple(round(v, 6) if isinstance(v, float) else v for v in r) for r in rows)


def batch_trends(rows):
    """The same with the operators for tables, window by window."""
    scores = health.score_by_ts(rows, "session")
    covering = F.explode(F.transform(F.sequence(F.lit(0), F.lit(4)), lambda k: F.col("ts") - F.pmod("ts", F.lit(60)) - 60 * k))
    copies = scores.withColumn("window_start", covering)
    summed = health.running_sum(copies, "session", "window_start", chunk_seconds=60)
    fitted = health.trend(summed, "session", "window_start")
    last = summed.groupBy("session", "window_start").agg(F.max_by("cumsum", "ts").alias("total"))
    return fitted.join(last, ["session", "window_start"]).selectExpr(
        "session", "window_start", "window_start + 300 window_end", "n", "x_min", "x_max", "total", "c0", "c1", "root"
    )


def test_trends_of_tables_and_streams_agree(spark, tmp_path):
    rows = spark.createDataFrame(points(), DETECTION)
    expected = rounded(batch_trends(rows).collect())
    table = trends.health_trends(windows.assign_event_time(rows), "session", 300, 60)
    assert rounded(table.collect()) == expected and len(expected) > 12
    source = str(tmp_path / "in")
    for part in (rows.where("ts < 250"), rows.where("ts >= 250")):
        part.coalesce(1).write.mode("append").parquet(source)
    spark.createDataFrame([("end", 10_000, 1.0, 1.0)], DETECTION).coalesce(1).write.mode("append").parquet(source)

    def stream():
        arriving = spark.readStream.schema(DETECTION).option("maxFilesPerTrigger", 1).parquet(source)
        timed = streams.with_lateness(windows.assign_event_time(arriving), "10 minutes")
        return trends.health_trends(timed, "session", 300, 60)

    closed, query = drain(spark, stream(), tmp_path)
    assert rounded(closed.collect()) == expected
    # State holds seconds, panes and windows; none of them is kept when its time has passed.
    left = [s["numRowsTotal"] for s in json.loads(query.lastProgress.json)["stateOperators"]]
    assert sum(left) <= 8
    with pytest.raises(ValueError, match="multiple"):
        trends.health_trends(windows.assign_event_time(rows), "session", 300, 70)


def test_trends_go_on_after_a_restart(spark, tmp_path):
    rows = spark.createDataFrame(points(), DETECTION)
    source = str(tmp_path / "in")
    found = None
    for part in (rows.where("ts < 61"), rows.where("ts >= 61"), spark.createDataFrame([("end", 9999, 1.0, 1.0)], DETECTION)):
        part.coalesce(1).write.mode("append").parquet(source)
        timed = streams.with_lateness(windows.assign_event_time(spark.readStream.schema(DETECTION).parquet(source)), "1 hour")
        found, _ = drain(spark, trends.health_trends(timed, "session", 300, 60), tmp_path)
    assert rounded(found.collect()) == rounded(batch_trends(rows).collect())


def frame(session, ts):
    metadata = {"ts": ts, "session": session, "datesegment": "2021/01/01", "device_id": 1}
    return json.dumps({"data": "aW1n", "metadata": metadata})


def test_health_job(spark, tmp_path):
    inbox = tmp_path / "frames"
    inbox.mkdir()
    bad = frame("a", 5).replace('"ts": 5', '"ts": "soon"')
    (inbox / "1.txt").write_text("\n".join([*(frame("a", t) for t in (0, 30, 61)), bad, frame("z", 90_000)]))

    def load():
        # Class 3 before ids start at 1: a print, of weight 1.
        return lambda images: [([[0.1, 0.1, 0.2, 0.2]], [3], [0.5], 1) for _ in images]

    config = HealthJobConfig(bucket="b", base_path="p", module="m", checkpoint=str(tmp_path / "cp"), model_version="t1")
    frames = jobs.scored_frames(read_messages(spark, str(inbox), fmt="text"), load, config)
    jobs.health_trends(frames, config, str(tmp_path / "trends")).awaitTermination()
    found = spark.read.parquet(str(tmp_path / "trends")).where("session = 'a' AND window_start = 0").collect()
    assert [(r.n, r.x_min, r.x_max, r.total) for r in found] == [(3, 0, 61, 1.5)]
    none = spark.createDataFrame([], "device_id int, valid_from bigint, c_ymin double, c_xmin double, c_ymax double, c_xmax double")
    out = str(tmp_path / "out")
    jobs.annotate_and_archive(
        read_messages(spark, str(inbox), fmt="text"), lambda: none, load, config, out
    ).awaitTermination()
    assert [r.reject for r in spark.read.parquet(f"{out}/rejects").collect()] == ["bad metadata.ts"]
    assert spark.read.parquet(f"{out}/manifest").count() == 4


# --- message log ---------------------------------------------------------------------------------


def publish(spark, folder, path, checkpoint, *values, **kwargs):
    spark.createDataFrame([(v,) for v in values], "value string").coalesce(1).write.mode("append").parquet(folder)
    rows = spark.readStream.schema("value string").parquet(folder)
    log.publish(rows, path, checkpoint, **kwargs).awaitTermination()


def visible(spark, path):
    return sorted(r.value for r in log.subscribe(spark, path, streaming=False).collect())


def read(spark, rows, base, name):
    runner.to_files(rows, f"{base}/{name}", f"{base}/{name}-checkpoint").awaitTermination()
    return sorted(r.value for r in spark.read.schema("value string").parquet(f"{base}/{name}").collect())


def test_subscriptions_resume_and_topics_start_anew(spark, tmp_path):
    path, inbox, sending = (str(tmp_path / n) for n in ("log", "in", "sending"))
    publish(spark, inbox, path, sending, "a", "b")
    assert read(spark, log.subscribe(spark, path, "s", start="earliest"), tmp_path, "one") == ["a", "b"]
    assert read(spark, log.subscribe(spark, path), tmp_path, "new") == []
    publish(spark, inbox, path, sending, "c")
    assert read(spark, log.subscribe(spark, path, "s", start="earliest"), tmp_path, "one") == ["a", "b", "c"]
    # The query without a name has its place in its checkpoint.
    assert read(spark, log.subscribe(spark, path), tmp_path, "new") == ["c"]
    publish(spark, inbox, path, sending, "d")
    late_one = read(spark, log.subscribe(spark, path, "s", start="earliest"), tmp_path, "other")
    # On a new checkpoint a named subscription goes on where it was last known to be.
    assert "d" in late_one and "a" not in late_one
    assert visible(spark, path) == ["a", "b", "c", "d"]


def test_what_failed_is_not_visible(spark, tmp_path):
    path, inbox, sending = (str(tmp_path / n) for n in ("log", "in", "sending"))
    publish(spark, inbox, path, sending, "a")
    spark.createDataFrame([(f"b{k}",) for k in range(40)], "value string").repartition(4).write.mode("append").parquet(inbox)
    rows = spark.readStream.schema("value string").parquet(inbox)
    broken = rows.withColumn("value", F.when(F.col("value") == "b7", F.raise_error(F.lit("lost"))).otherwise(F.col("value")))
    with pytest.raises(Exception, match="lost"):
        log.publish(broken, path, sending).awaitTermination()
    # A crash may leave files that no entry names.
    (tmp_path / "log/data/orphan.parquet").write_bytes(b"half a file")
    assert visible(spark, path) == ["a"]
    log.publish(rows, path, sending).awaitTermination()
    assert visible(spark, path) == ["a", *sorted(f"b{k}" for k in range(40))]


def test_an_epoch_is_visible_once(spark, tmp_path):
    """A publisher that stopped after its entry and before Spark's own commit publishes the epoch again."""
    path, inbox, sending = (str(tmp_path / n) for n in ("log", "in", "sending"))
    publish(spark, inbox, path, sending, "a", "b")
    commits = sorted((tmp_path / "sending/commits").glob("[0-9]*"))
    for f in (commits[-1], commits[-1].with_name(f".{commits[-1].name}.crc")):
        f.unlink(missing_ok=True)
    log.publish(spark.readStream.schema("value string").parquet(inbox), path, sending).awaitTermination()
    assert visible(spark, path) == ["a", "b"]
    with pytest.raises(Exception, match="another publisher"):
        publish(spark, inbox, path, str(tmp_path / "else"), "c")
    assert visible(spark, path) == ["a", "b"]


def test_tables_are_published_and_empty_logs_read(spark, tmp_path):
    path = str(tmp_path / "log")
    assert visible(spark, path) == []
    rows = spark.createDataFrame([("x",), (None,)], "value string")
    for _ in range(2):
        rows.write.format(log.FORMAT).mode("append").save(path)
    assert log.subscribe(spark, path, streaming=False).count() == 4


# --- late rows, joins ----------------------------------------------------------------------------


def test_late_rows_are_kept_apart(spark, tmp_path):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    schema = "session string, ts long"
    for ts in ([10, 70], [500], [20, 505, None], [499, 2000], [1999]):
        spark.createDataFrame([("a", t) for t in ts], schema).coalesce(1).write.mode("append").parquet(source)
        rows = windows.assign_event_time(spark.readStream.schema(schema).parquet(source))
        late.split_late(rows, out, f"{out}-checkpoint").awaitTermination()
        timed = streams.with_lateness(rows.where("ts IS NOT NULL"))
        query = runner.to_files(streams.drop_repeats(timed, "session", "ts"), f"{out}-spark", f"{out}-spark-checkpoint")
        query.awaitTermination()
    missed = spark.read.parquet(f"{out}/late").orderBy("ts").collect()
    assert [(r.ts, r.late_ms) for r in missed] == [(20, 480_000), (499, 6_000), (1999, 1_000)]
    kept = [r.ts for r in spark.read.parquet(f"{out}/kept").collect()]
    assert sorted(t or -1 for t in kept) == [-1, 10, 70, 500, 505, 2000]
    # Spark's own operator drops the same rows.
    own = [r.ts for r in spark.read.parquet(f"{out}-spark").collect()]
    assert sorted(own) == sorted(t for t in kept if t is not None)


def test_requests_wait_for_frames(spark, tmp_path):
    asked, seen = str(tmp_path / "asked"), str(tmp_path / "seen")
    when = "timestamp_seconds(%d)"

    def request(session, started, requested):
        return spark.sql(f"SELECT '{session}' session, {when % started} started, {when % requested} requested")

    def frame_at(session, ts):
        return spark.sql(f"SELECT '{session}' session, {when % ts} event_time, {ts}L ts")

    arrivals = [
        (request("a", 100, 200).union(request("b", 100, 200)), frame_at("a", 150)),
        (None, frame_at("a", 199).union(frame_at("a", 50)).union(frame_at("c", 150))),
        (request("z", 9000, 9000), frame_at("z", 9000)),
    ]
    for sent, arrived in arrivals:
        for rows, folder in ((sent, asked), (arrived, seen)):
            if rows is not None:
                rows.coalesce(1).write.mode("append").parquet(folder)
        left = spark.readStream.schema("session string, started timestamp, requested timestamp").parquet(asked)
        right = spark.readStream.schema("session string, event_time timestamp, ts long").parquet(seen)
        joined = joins.frames_of_requests(
            left.withWatermark("requested", "10 minutes"), right.withWatermark("event_time", "10 minutes"), 300
        )
        out, _ = drain(spark, joined, tmp_path)
    got = sorted(((r.session, r.ts) for r in out.collect() if r.session != "z"), key=str)
    assert got == [("a", 150), ("a", 199), ("b", None)]


# --- models --------------------------------------------------------------------------------------


def test_a_worker_loads_a_model_once(spark, tmp_path):
    loads = tmp_path / "loads"
    loads.mkdir()

    def load():
        import os
        import uuid

        (loads / f"{os.getpid()}-{uuid.uuid4().hex}").write_text("")
        return lambda images: [([], [], [], 0) for _ in images]

    frames = spark.range(64).selectExpr("id", "cast('x' as binary) image_data").repartition(64)
    for _ in range(3):
        assert score_frames(frames, load, version=str(tmp_path)).where("annotations_all IS NULL").count() == 0
    made = [f.name.split("-")[0] for f in loads.iterdir()]
    # 192 tasks on 8 cores; a worker that ends takes its model with it.
    assert len(made) == len(set(made)) and len(made) <= 24


def test_versions_are_different_models():
    _held.clear()
    calls = []
    for version in ("a", "b", "a", "c", "a", "b"):
        held(version, lambda version=version: calls.append(version) or (lambda images: version))
    assert calls == ["a", "b", "c", "b"] and len(_held) == KEPT
    _held.clear()


def test_state_of_trends_does_not_grow_with_the_keys(spark, tmp_path):
    source = str(tmp_path / "in")
    weight, score = "if(id % 13 < 6, -0.5D, 1.0D) health_weight", "(id % 13 - 6) / 8.0D health_score"
    rows = spark.range(2002).selectExpr("concat('s', id % 1001) session", "id % 7 * 47 ts", weight, score)
    rows.coalesce(1).write.parquet(source)
    spark.createDataFrame([("end", 10_000, 1.0, 1.0)], DETECTION).coalesce(1).write.mode("append").parquet(source)
    timed = streams.with_lateness(windows.assign_event_time(spark.readStream.schema(DETECTION).parquet(source)))
    closed, query = drain(spark, trends.health_trends(timed, "session", 300, 60), tmp_path)
    expected = rounded(batch_trends(rows).collect())
    assert rounded(closed.where("session <> 'end'").collect()) == expected and len(expected) > 5000
    updated = [json.loads(p.json)["stateOperators"][0]["numRowsUpdated"] for p in query.recentProgress]
    assert sum(updated) <= 12 * streams.BUCKETS


def test_trend_of_an_almost_flat_line_keeps_its_digits(spark):
    rows = spark.createDataFrame([("a", 17_990, 1.0, 1000.0), ("a", 17_999, 1.0, 0.0001)], DETECTION)
    found = trends.health_trends(windows.assign_event_time(rows), "session", 18_000, 3600).where("window_start = 0").first()
    assert found.c1 == pytest.approx((1000.0 + 0.0001 - 1000.0) / 2, rel=1e-9)
