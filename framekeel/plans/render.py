"""From a finished session to a render request, a render manifest and an alert."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.paths import join_path, typed_path
from ..operators.lookups import per_key
from ..schemas import METADATA
from ..sources.messages import encode

ALERT_PATH = "media/uploads/PrintSessionAlert"
VIDEO_NAME = "annotated_video.mp4"


def metadata_struct(df: DataFrame, prefix: str = "") -> Column:
    """The metadata of a message from flat columns; columns that are missing become null."""
    return F.struct(
        *(
            (F.col(prefix + f.name) if prefix + f.name in df.columns else F.lit(None))
            .cast(f.dataType)
            .alias(f.name)
            for f in METADATA.fields
        )
    )


def render_requests(latest: DataFrame) -> DataFrame:
    """Render request of each finished session, from the columns of its latest frame.

    Adds ``value``, the message to publish.
    """
    path = join_path(ALERT_PATH, F.col("datesegment"), F.col("session"))
    return (
        latest.withColumn("cdn_output_path", path)
        .withColumn("metadata", metadata_struct(latest))
        .withColumn("value", encode("cdn_output_path", "metadata"))
    )


def latest_metadata(sessions: DataFrame) -> DataFrame:
    """Name the ``latest_*`` columns of a session like message metadata."""
    names = [c for c in sessions.columns if c.startswith("latest_")]
    return sessions.select(
        "session",
        "session_end",
        *(F.col(c).alias(c.removeprefix("latest_")) for c in names if c != "latest_event_time"),
    )


def render_manifest(
    requests: DataFrame,
    frames: DataFrame,
    *,
    bucket: str,
    base_path: str,
    module: str,
    protocol: str = "gs://",
) -> DataFrame:
    """What to render for each request: paths, number of frames, first and last of them.

    ``frames`` is the frame manifest with ``session, datesegment, ts, outpath``. Only frames of requested
    sessions are read on: if the manifest is partitioned by ``datesegment``, other days are skipped. They are
    reduced to one row per session before the join, so requests for the same session do not multiply.
    """
    listed = requested_frames(requests, frames)
    return listed_manifest(requests, listed, bucket=bucket, base_path=base_path, module=module, protocol=protocol)


def listed_manifest(
    requests: DataFrame, listed: DataFrame, *, bucket: str, base_path: str, module: str, protocol: str = "gs://"
) -> DataFrame:
    """:func:`render_manifest` from the frames of requested sessions only, such as :func:`render_frames` lists."""
    per_session = listed.groupBy("datesegment", "session").agg(
        F.count("*").alias("frame_count"),
        F.min("ts").alias("first_ts"),
        F.max("ts").alias("last_ts"),
    )
    key, date = F.col("session"), F.col("datesegment")
    return (
        requests.join(per_session, ["datesegment", "session"], "left")
        .withColumn("frame_count", F.coalesce("frame_count", F.lit(0)))
        .withColumn("input_path", typed_path(bucket, base_path, key, date, module, "jpg", "", protocol))
        .withColumn(
            "output_path", typed_path(bucket, base_path, key, date, module, "mp4", VIDEO_NAME, protocol)
        )
        .withColumn("video_path", join_path(protocol, bucket, F.col("cdn_output_path"), VIDEO_NAME))
    )


def requested_frames(requests: DataFrame, frames: DataFrame) -> DataFrame:
    wanted = per_key(requests, ["datesegment", "session"])
    return frames.join(wanted, ["datesegment", "session"], "left_semi")


def render_frames(requests: DataFrame, frames: DataFrame) -> DataFrame:
    """The frames of requested sessions, one row each."""
    return requested_frames(requests, frames).select("session", "datesegment", "ts", "outpath")


def playing_order(listed: DataFrame) -> DataFrame:
    """Add ``place``, the number of the frame in its session's video, from 1."""
    order = Window.partitionBy("datesegment", "session").orderBy("ts", "outpath")
    return listed.withColumn("place", F.row_number().over(order))


def write_render_frames(listed: DataFrame, path: str, mode: str = "append") -> None:
    """Write frame lists in playing order: files, and rows within them, ordered by session and time."""
    order = ["session", F.col("ts"), "outpath"]
    listed.repartitionByRange(*order).sortWithinPartitions(*order).write.mode(mode).parquet(path)


def alerts(manifest: DataFrame) -> DataFrame:
    """The request, unchanged, for every session that has frames to render."""
    return manifest.where(F.col("frame_count") > 0)
