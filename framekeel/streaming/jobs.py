"""The frame job and the render job as streaming queries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..config import HealthJobConfig, RenderJobConfig
from ..functions.paths import window_stem
from ..operators import windows
from ..operators.metrics import observe_durations
from ..operators.nested import drop_images, explode_detections, merge_filtered
from ..operators.overlay import manifest, overlay_plans
from ..operators.scoring import score_frames
from ..plans import render
from ..schemas import METADATA, MONITORING_IMAGE, VIDEO_RENDER_REQUEST
from ..sources.messages import decode, explain_malformed, publish, with_reject
from . import runner, state, trends
from .windows import drop_repeats, session_latest, with_lateness


#: Fields without which a frame has no window, no path and no session.
REQUIRED = ("metadata.ts", "metadata.session", "metadata.datesegment")
REJECTS = "rejects"
HEARTBEAT = "\u0000heartbeat"


def frames_from_messages(messages: DataFrame) -> DataFrame:
    """Frames with event time from raw messages, with ``reject``, the reason why a message is no frame.

    A reject keeps its message as text in ``rejected``, a null body as an empty one.
    """
    decoded = explain_malformed(decode(messages, MONITORING_IMAGE), MONITORING_IMAGE)
    decoded = with_reject(decoded, REQUIRED)
    image, bad = F.col("message.data"), F.col("reject").isNotNull()
    frames = decoded.select(
        "reject",
        F.when(bad, F.coalesce(F.col("value").cast("string"), F.lit(""))).alias("rejected"),
        F.when(~bad & (F.octet_length(image) > 0), image).alias("image_data"),
        "message.metadata.*",
    )
    return windows.assign_event_time(frames)


def _write(rows: DataFrame, path: str, batch_id: int, *partition_by: str) -> None:
    rows.write.mode("overwrite").partitionBy(*partition_by).parquet(runner.batch_path(path, batch_id))


def annotate_and_archive(
    messages: DataFrame,
    calibrations: Callable[[], DataFrame],
    load_model: Callable[[], Callable],
    config: HealthJobConfig,
    out: str,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Score frames and archive every message, then write the overlay manifest and two error outputs below ``out``.

    A micro-batch is read, decoded and scored once, on its way into the archive: all frames with their
    images, in a folder per window, and rejected messages in one of their own, without a shuffle. The
    other outputs are read from there, without images, so they agree with it also after a lost
    executor or a replay. The durations of the model's calls are metrics ``predict`` of the query's progress.
    With ``config.repeats_within``, frames delivered again within that time are dropped, and so are frames
    that come later than it. ``calibrations`` is read anew for every batch, so new devices are seen; with versions
    (:func:`framekeel.sources.calibrations.read_versions`) each frame gets the one of its time, also in a replay. With
    ``config.model_version``, Python workers keep the model between tasks and batches. On a checkpoint of other windows,
    repeats or columns the start is refused (:class:`state.ChangedJob`).
    """
    frames = frames_from_messages(messages)
    if config.repeats_within:
        good = with_lateness(frames.where("reject IS NULL"), config.repeats_within)
        once = drop_repeats(good, "session", "ts", "device_id")
        frames = once.unionByName(frames.where("reject IS NOT NULL"))
    scored = score_frames(frames, load_model, keep_image=True, version=config.model_version)
    scored = observe_durations(scored, "predict_ms", "predict")

    def write(batch: DataFrame, batch_id: int) -> None:
        start = F.col("ts") - F.pmod("ts", F.lit(config.window_period_seconds))
        stem = window_stem(start, start + config.window_period_seconds)
        rows = batch.withColumn("window", F.when(F.col("reject").isNull(), stem).otherwise(REJECTS))
        _write(rows, f"{out}/archive", batch_id, "window")
        reader = batch.sparkSession.read.schema(rows.schema)
        stored = reader.parquet(runner.batch_path(f"{out}/archive", batch_id))
        rejects = stored.where(F.col("window") == REJECTS).select(F.col("rejected").alias("value"), "reject")
        _write(rejects, f"{out}/{REJECTS}", batch_id)
        frames = drop_images(stored.where(F.col("window") != REJECTS)).drop("reject", "rejected", "window")
        has_image = F.col("annotations_all").isNotNull()
        _write(frames.where(~has_image), f"{out}/frames_without_image", batch_id)
        annotated = frames.where(has_image).withColumn("detections", F.col("annotations_all.detections"))
        plans = overlay_plans(
            merge_filtered(annotated, calibrations()),
            bucket=config.bucket,
            base_path=config.base_path,
            module=config.module,
            max_boxes=config.max_boxes_to_draw,
            min_score=config.min_score_threshold,
            protocol=config.protocol,
        )
        # Rows are narrow here; a day's meet in one task, unless they are too many, so a day has few files.
        drawn = manifest(plans, "datesegment", "ts", "overlay").hint("rebalance", F.col("datesegment"))
        _write(drawn, f"{out}/manifest", batch_id, "datesegment")

    checkpoint = f"{config.checkpoint}/annotate"
    options = {"window_period_seconds": config.window_period_seconds, "repeats_within": config.repeats_within}
    state.keep_options(scored, checkpoint, options)
    return runner.each_batch(scored, write, checkpoint, trigger=trigger)


def health_trends(frames: DataFrame, config: HealthJobConfig, out: str, trigger: dict | None = None) -> StreamingQuery:
    """Append the health trend of each session's sliding windows, as they close, to the table ``out``.

    ``frames`` is a stream of scored frames with ``annotations_all``, such as :func:`scored_frames`; the windows are
    those of ``config``. On a checkpoint of other windows the start is refused (:class:`state.ChangedJob`).
    """
    narrow = with_lateness(frames.select("event_time", "ts", "session", "annotations_all"), config.watermark_delay)
    found = narrow.select("event_time", "ts", "session", F.col("annotations_all.detections").alias("detections"))
    rows = explode_detections(found, "event_time")
    closed = trends.health_trends(rows, "session", config.window_size_seconds, config.window_period_seconds)
    checkpoint = f"{config.checkpoint}/trends"
    options = {n: getattr(config, n) for n in ("window_size_seconds", "window_period_seconds")}
    state.keep_options(closed, checkpoint, options)
    return runner.to_files(closed, out, checkpoint, trigger=trigger)


def scored_frames(messages: DataFrame, load_model: Callable[[], Callable], config: HealthJobConfig) -> DataFrame:
    """The frames of a stream of messages with ``annotations_all``, without images and rejects."""
    frames = frames_from_messages(messages).where("reject IS NULL").drop("reject", "rejected")
    return score_frames(frames, load_model, version=config.model_version)


def request_renders(
    messages: DataFrame,
    config: HealthJobConfig,
    out: str,
    trigger: dict | None = None,
    heartbeat: DataFrame | None = None,
) -> StreamingQuery:
    """Publish a render request when a session has been quiet for the gap. Needs no model and no images.

    Event time only moves with rows, so when all devices go quiet their last sessions stay open. A
    ``heartbeat``, a stream with a ``timestamp`` such as the rate source, moves it on; frames that come
    later than the heartbeat and the watermark's delay are then dropped. On a checkpoint of another gap the start is
    refused (:class:`state.ChangedJob`).
    """
    carry = [f.name for f in METADATA.fields if f.name not in ("session", "ts")]
    frames = frames_from_messages(messages).where("reject IS NULL")
    frames = frames.select("event_time", "session", "ts", *carry)
    if heartbeat is not None:
        nothing = (F.lit(None).cast(frames.schema[c].dataType).alias(c) for c in ("ts", *carry))
        beat = F.col("timestamp").cast("timestamp").alias("event_time")
        frames = frames.unionByName(heartbeat.select(beat, F.lit(HEARTBEAT).alias("session"), *nothing))
    narrow = with_lateness(frames, config.watermark_delay)
    if config.repeats_within:
        narrow = drop_repeats(narrow, "session", "event_time", "device_id")
    finished = session_latest(narrow, "session", config.session_gap_seconds, "ts", *carry)
    # A condition on the session itself would move below the watermark, which must see the heartbeat.
    finished = finished.where(F.col("latest_ts").isNotNull())
    requests = render.render_requests(render.latest_metadata(finished))
    checkpoint = f"{config.checkpoint}/requests"
    options = {"session_gap_seconds": config.session_gap_seconds, "repeats_within": config.repeats_within}
    state.keep_options(requests, checkpoint, options)
    return publish(requests, out, checkpoint=checkpoint, trigger=trigger)


def render_and_alert(
    requests: DataFrame,
    frame_manifest: Callable[[], DataFrame],
    config: RenderJobConfig,
    out: str,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Turn published requests into render manifests, ordered frame lists and alerts below ``out``.

    A micro-batch is decoded once, into ``requests``, and the frame manifest is read once, into the frame lists. The
    other outputs are made from these, so counts agree with the lists also if the manifest grows meanwhile.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        def written(rows: DataFrame, name: str) -> DataFrame:
            return batch.sparkSession.read.schema(rows.schema).parquet(runner.batch_path(f"{out}/{name}", batch_id))

        decoded = decode(batch, VIDEO_RENDER_REQUEST).select(
            "value",
            F.col("message.cdn_output_path").alias("cdn_output_path"),
            F.col("message.metadata.session").alias("session"),
            F.col("message.metadata.datesegment").alias("datesegment"),
            "is_malformed",
        )
        _write(decoded, f"{out}/requests", batch_id)
        stored = written(decoded, "requests")
        good = stored.where(~F.col("is_malformed")).drop("is_malformed")
        listed = render.render_frames(good, frame_manifest())
        render.write_render_frames(listed, runner.batch_path(f"{out}/frames", batch_id), "overwrite")
        renders = render.listed_manifest(
            good,
            written(listed, "frames"),
            bucket=config.bucket,
            base_path=config.base_path,
            module=config.module,
            protocol=config.protocol,
        )
        _write(renders, f"{out}/renders", batch_id)
        # Alerts are for what was rendered, so they come from there.
        _write(render.alerts(written(renders, "renders")).select("value"), f"{out}/alerts", batch_id)
        _write(stored.where("is_malformed").select("value"), f"{out}/malformed", batch_id)

    return runner.each_batch(requests, write, f"{config.checkpoint}/render", trigger=trigger)

