"""Queries of chained streams, the message log, versions, late rows, contracts and compaction."""

from __future__ import annotations

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import health_weight
from ..operators import asof, nested, scoring, windows
from ..schemas import MONITORING_IMAGE
from ..session import fresh_dir
from ..sources import archive, log, messages
from ..sources import calibrations as calibration_source
from ..streaming import jobs, joins, late, runner, state, trends
from ..streaming import windows as stream_windows
from . import queries, render, tables
from .tables import DAY, GAP, WINDOW

HOUR = 3600
#: Longest stretch of a session, and how long requests wait for late frames, in the join of two streams.
REACH, WAIT = 3000 * DAY, "3000 days"


def _detections(rows: DataFrame) -> DataFrame:
    """Events as detections: class and score come from their numbers."""
    found = (F.col("event_id") % 7).cast("int")
    return rows.select(
        "event_time",
        "user_id",
        health_weight(found).alias("health_weight"),
        (health_weight(found) * F.col("value") / 100).alias("health_score"),
    )


def stream_health_trend(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The health trend of each user's sliding windows that have closed."""
    rows = _detections(queries._event_stream(spark, sf_dir))
    found = queries._drain(spark, trends.health_trends(rows, "user_id", 5 * HOUR, HOUR), "health-trend")
    return queries._rounded(found, "total", "c0", "c1").withColumn("root", F.round("root", 0))


def _halves(spark, sf_dir):
    """Events as messages that arrive in two halves, each as a folder."""
    source = tables.table(spark, sf_dir, "events").withColumn("us", F.unix_micros(F.col("ts").cast("timestamp")))
    sent = source.select("event_id", messages.encode("event_id", "us", "user_id", "event_type"))
    middle = source.agg((F.min("event_id") + F.max("event_id")) / 2).first()[0]
    return [sent.where(F.col("event_id") <= middle), sent.where(F.col("event_id") > middle)]


def _arrived(rows):
    schema = "event_id bigint, us bigint, user_id bigint, event_type string"
    return rows.withColumn("message", F.from_json("value", schema)).select("message.*")


def stream_subscription(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Publisher and subscriber of a log, both stopped in the middle and started again: each message once."""
    inbox, path, out = (fresh_dir(spark, n) for n in ("halves", "log", "subscribed"))
    sending, reading = fresh_dir(spark, "sending"), fresh_dir(spark, "reading")
    for half in _halves(spark, sf_dir):
        half.write.mode("append").parquet(inbox)
        sent = spark.readStream.schema("event_id bigint, value string").parquet(inbox)
        log.publish(sent, path, sending).awaitTermination()
        rows = log.subscribe(spark, path, "viewer", start="earliest")
        runner.to_files(rows, out, reading).awaitTermination()
    return _arrived(spark.read.schema("value string").parquet(out))


def stream_publish_commit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a reader of a log sees after a task of the second epoch has failed, and after its epoch came again.

    ``seen`` is 1 for messages visible after the failure, 2 for those visible only at the end.
    """
    inbox, path, sending = (fresh_dir(spark, n) for n in ("epochs", "log", "sending"))
    seen = []
    for turn, half in enumerate(_halves(spark, sf_dir)):
        half.write.mode("append").parquet(inbox)
        sent = spark.readStream.schema("event_id bigint, value string").parquet(inbox)
        if turn:
            # Some tasks write all they have before one meets the message that breaks it.
            broken = F.when(F.col("event_id") % 11 == 7, F.raise_error(F.lit("lost"))).otherwise(F.col("value"))
            try:
                log.publish(sent.withColumn("value", broken), path, sending).awaitTermination()
            except PySparkException:
                visible = log.subscribe(spark, path, streaming=False)
                shown = fresh_dir(spark, "visible")
                visible.write.parquet(shown)
                seen.append(spark.read.schema("value string").parquet(shown).withColumn("seen", F.lit(1)))
        log.publish(sent, path, sending).awaitTermination()
    whole = log.subscribe(spark, path, streaming=False).withColumn("seen", F.lit(2))
    rows = seen[0].unionByName(whole).groupBy("value").agg(F.min("seen").alias("seen"), F.count("*").alias("times"))
    found = rows.withColumn("message", F.from_json("value", "event_id bigint, us bigint")).select("message.*", "seen", "times")
    # A message of the first epoch is seen twice, as it is visible both times.
    return found.select("event_id", "us", "seen", (F.col("times") + F.col("seen") - 2).cast("int").alias("copies"))


def _versions(spark, sf_dir):
    """Calibrations of each device that change with its first frame of every year, some days later."""
    rows = tables.frames(spark, sf_dir, device=True).where("device_id IS NOT NULL")
    year = F.year("event_time")
    firsts = rows.groupBy("device_id", year.alias("year")).agg(F.min("ts").alias("first"))
    low = 0.1 + F.pmod(F.col("year") + F.col("device_id"), F.lit(4)) / 10
    return firsts.where("device_id % 5 <> 0").select(
        "device_id",
        (F.col("first") + F.col("device_id") * DAY).alias("valid_from"),
        *(low.alias(f"c_{n}") for n in ("ymin", "xmin")),
        *(F.lit(0.8).alias(f"c_{n}") for n in ("ymax", "xmax")),
    )


def calibration_asof(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The calibration that was in force for each frame."""
    frames = tables.frames(spark, sf_dir, device=True).select("frame_id", "device_id", "ts")
    found = asof.asof_join(frames, _versions(spark, sf_dir), ["device_id"], chunk_seconds=WINDOW)
    return found.select("frame_id", "device_id", F.round("c_ymin", 6).alias("c_ymin"), "c_ymax")


def _requests(spark, sf_dir):
    """A request per session of a customer, from its first to its latest frame."""
    rows = tables.frames(spark, sf_dir)
    found = windows.sessions(rows, "session", GAP, "frame_id")
    return found.select(
        "session",
        F.col("session_start").cast("timestamp").alias("started"),
        F.col("latest_event_time").cast("timestamp").alias("requested"),
    )


def stream_render_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requests with the urgent frames of their session; half of the frames come after the requests, and some never."""
    asked, seen, out = (fresh_dir(spark, n) for n in ("asked", "seen", "rendered"))
    checkpoint = fresh_dir(spark, "rendered-checkpoint")
    frames = tables.frames(spark, sf_dir).where("payload = '1-URGENT'").select("session", "event_time", "frame_id")
    frames = frames.withColumn("event_time", F.col("event_time").cast("timestamp"))
    requests = _requests(spark, sf_dir)
    # What moves the watermarks past all requests at the end: a request and a frame of a time to come.
    ahead = F.timestamp_seconds(F.lit(10_000_000_000))
    last_frame = spark.range(1).select(F.lit("-").alias("session"), ahead.alias("event_time"), F.lit(-1).cast("bigint").alias("frame_id"))
    last_request = spark.range(1).select(F.lit("-").alias("session"), ahead.alias("started"), ahead.alias("requested"))
    early = F.xxhash64("frame_id") % 2 == 0
    for sent, arrived in ((requests, frames.where(early)), (last_request.limit(0), frames.where(~early)), (last_request, last_frame)):
        sent.write.mode("append").parquet(asked)
        arrived.write.mode("append").parquet(seen)
        left = spark.readStream.schema(requests.schema).parquet(asked).withWatermark("requested", WAIT)
        right = spark.readStream.schema(frames.schema).parquet(seen).withWatermark("event_time", WAIT)
        joined = joins.frames_of_requests(left, right, REACH)
        schema = joined.schema
        runner.to_files(joined, out, checkpoint).awaitTermination()
    found = spark.read.schema(schema).parquet(out).where("session <> '-'")
    return found.select("session", F.unix_seconds("requested").alias("requested"), "frame_id")


def stream_late_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events in three arrivals, the last one late: how many rows of each user were kept, and how late the others were."""
    source = tables.table(spark, sf_dir, "events").withColumn("event_time", F.col("ts").cast("timestamp"))
    micros = F.unix_micros("event_time")
    low, high = source.agg(F.min(micros), F.max(micros)).first()
    arrival = F.when(micros >= (low + high) // 2, 1).when(F.col("event_id") % 10 == 0, 2).otherwise(0)
    inbox, out, checkpoint = (fresh_dir(spark, n) for n in ("arrivals", "late", "late-checkpoint"))
    rows = source.select("event_id", "user_id", "event_time").withColumn("arrival", arrival)
    for k in range(3):
        rows.where(F.col("arrival") == k).drop("arrival").write.mode("append").parquet(inbox)
        stream = spark.readStream.schema(rows.drop("arrival").schema).parquet(inbox)
        late.split_late(stream, out, checkpoint, delay_seconds=HOUR).awaitTermination()
    kept = spark.read.parquet(f"{out}/{late.KEPT}").select("user_id", F.lit(None).cast("bigint").alias("late_ms"))
    missed = spark.read.parquet(f"{out}/{late.LATE}").select("user_id", "late_ms")
    return kept.unionByName(missed).groupBy("user_id").agg(
        F.count_if(F.col("late_ms").isNull()).alias("n_kept"),
        F.count("late_ms").alias("n_late"),
        F.min("late_ms").alias("least_ms"),
        F.max("late_ms").alias("most_ms"),
    )


def _stopped(spark, sf_dir, name, delay, aggregate):
    """The checkpoint of a query that was stopped in the middle of the events' time and went on from its state."""
    source = tables.table(spark, sf_dir, "events").withColumn("event_time", F.col("ts").cast("timestamp"))
    micros = F.unix_micros("event_time")
    low, high = source.agg(F.min(micros), F.max(micros)).first()
    middle = (low + high) // 2
    inbox, out, checkpoint = (fresh_dir(spark, f"{name}{part}") for part in ("-events", "", "-checkpoint"))
    for half in (source.where(micros < middle), source.where(micros >= middle)):
        half.write.mode("append").parquet(inbox)
        stream = stream_windows.with_lateness(spark.readStream.schema(source.schema).parquet(inbox), delay)
        found = aggregate(stream)
        state.keep_options(found, checkpoint, {"delay": delay})
        runner.to_files(found, out, checkpoint).awaitTermination()
    return checkpoint


def stream_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The windows of each user that are still open once all events have been read, from the query's checkpoint."""
    stats = [f("value").alias(n) for n, f in {"n": F.count, "total": F.sum, "low": F.min, "high": F.max}.items()]
    checkpoint = _stopped(
        spark, sf_dir, "state", "10 days", lambda rows: stream_windows.window_stats(rows, "user_id", DAY, *stats)
    )
    return queries._rounded(state.open_windows(spark, checkpoint, "n", "total", "low", "high"), "total")


def stream_state_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sessions of each user that are still open once all events have been read, with their latest event so far."""

    def sessions(rows):
        return stream_windows.session_latest(rows, "user_id", queries.EVENT_GAP, "event_id", "event_type", "value")

    checkpoint = _stopped(spark, sf_dir, "state-sessions", "10 days", sessions)
    found = state.open_sessions(spark, checkpoint, "n_rows", "latest")
    latest = (F.col(f"latest.{c}").alias(f"latest_{c}") for c in ("event_id", "event_type", "value"))
    return queries._session_columns(found.select("user_id", "session_start", "session_end", "n_rows", *latest))


def decode_problems(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages whose fields have wrong types, field by field, beside those that are no messages at all."""
    rows = tables.frames(spark, sf_dir, device=True, datesegment=True)
    key = F.col("frame_id")
    value = messages.encode(F.col("payload").cast("binary").alias("data"), render.metadata_struct(rows).alias("metadata"))
    sent = rows.select("frame_id", value)
    text = F.when(key % 19 == 0, F.regexp_replace("value", r'"ts":[0-9]+', '"ts":"soon"')).otherwise(F.col("value"))
    text = F.when(key % 23 == 0, F.regexp_replace(text, r'"user_id":[0-9]+', '"user_id":[1]')).otherwise(text)
    text = F.when(key % 29 == 0, F.regexp_replace(text, r'"data":"[^"]*"', '"data":"*"')).otherwise(text)
    sent = sent.withColumn("value", F.when(key % 97 == 0, F.substring(text, 1, 20)).otherwise(text))
    decoded = messages.explain_malformed(messages.decode(sent, MONITORING_IMAGE), MONITORING_IMAGE)
    found = messages.with_reject(decoded, jobs.REQUIRED)
    return found.where("reject IS NOT NULL").select("frame_id", "reject")


def score_held_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Frames scored with a model that Python workers keep."""
    images = tables.spread(tables.table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))
    scored = scoring.score_frames(images, queries.stub_model(), image="embedding", version="stub 1")
    return queries._annotation_rows(scored.select("vec_id", F.col("annotations_all").alias("a")))


def broken_outputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Model output with numbers that are none, too large or too few."""
    raw = queries._raw_output(F.col("embedding"))
    turn = F.col("vec_id") % 5
    nan, infinite = F.lit(float("nan")), F.lit(float("inf"))

    def class_of(c, i):
        # One class of a vector is broken, another one in each kind of vector.
        return F.when(i != turn, c).when(turn == 0, nan).when(turn == 1, infinite).when(turn == 2, 2147483647.0).otherwise(c)

    classes = F.transform(raw["classes"], class_of)
    count = F.when(turn == 0, nan).when(turn == 1, infinite).when(turn == 2, -1.0).when(turn == 3, 1e12).otherwise(raw["count"])
    scores = F.when(turn == 3, F.slice(raw["scores"], 1, 2)).otherwise(raw["scores"])
    rows = tables.table(spark, sf_dir, "embeddings").select(
        "vec_id", nested.postprocess(raw["boxes"], classes, scores, count).alias("a")
    )
    return rows.select("vec_id", "a.num_detections", F.inline("a.detections")).select(
        "vec_id", "num_detections", "pos", "class", "score", "health_weight"
    )


def archive_compacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The frame job's archive, compacted in two steps, as a reader of the second snapshot sees it."""
    source, target = f"{queries._annotate(spark, sf_dir)}/archive", fresh_dir(spark, "compacted")
    middle = tables.frames(spark, sf_dir).agg(F.floor((F.min("ts") + F.max("ts")) / 2)).first()[0]
    for closed_before in (middle, 1 << 40):
        archive.compact_snapshot(spark, source, target, closed_before)
    stored = archive.read_snapshot(spark, target)
    return stored.select("window", "annotations_all.num_detections", "image_data", "_metadata.file_path").groupBy("window").agg(
        F.count("*").alias("n_frames"),
        F.sum("num_detections").alias("n_detections"),
        F.sum(F.octet_length("image_data").cast("bigint")).alias("image_bytes"),
        F.count_distinct("file_path").alias("n_files"),
    )


def calibration_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Calibration files recorded as versions, changed and recorded again: only changes make a version."""
    base, table = fresh_dir(spark, "calibration-files"), fresh_dir(spark, "calibration-versions")
    for step, valid_from in enumerate((0, 788_918_400, 820_454_400)):
        top = F.when((F.col("device_id") % 3 == 0) & F.lit(step > 0), 0.2).otherwise(F.col("c_ymin"))
        corners = F.array(top, "c_xmin", "c_ymax", "c_xmax")
        file = F.to_json(F.struct(F.struct(corners.alias("xy")).alias("box"), F.lit(1.0).alias("fps"))).alias("value")
        rows = tables.calibrations(spark, sf_dir).select("device_id", file)
        folder = f"{base}/{step}"
        rows.write.partitionBy("device_id").text(folder)
        calibration_source.record_versions(spark, folder, table, valid_from, filename="*.txt")
    found = calibration_source.read_versions(spark, table)
    return found.select("device_id", "valid_from", "c_ymin", "c_xmax", "fps")


QUERIES = {
    "stream_health_trend": stream_health_trend,
    "stream_subscription": stream_subscription,
    "stream_publish_commit": stream_publish_commit,
    "calibration_asof": calibration_asof,
    "calibration_versions": calibration_versions,
    "stream_render_join": stream_render_join,
    "stream_late_rejects": stream_late_rejects,
    "stream_state": stream_state,
    "stream_state_sessions": stream_state_sessions,
    "decode_problems": decode_problems,
    "score_held_model": score_held_model,
    "broken_outputs": broken_outputs,
    "archive_compacted": archive_compacted,
}
