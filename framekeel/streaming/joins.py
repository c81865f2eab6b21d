"""Requests that wait for late frames: two streams joined within a stretch of event time."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..contracts import check


def frames_of_requests(requests: DataFrame, frames: DataFrame, reach_seconds: int) -> DataFrame:
    """Every request with each frame of its session between its ``started`` and ``requested`` times, left outer.

    Both are streams with watermarks on ``requested`` and on the frames' ``event_time``. A frame may come before or
    after the request; state keeps a request until the watermark has passed its time, and a frame for
    ``reach_seconds``, the longest session. A request without frames is given out, with nulls, once no frame of its
    time can come any more. The other columns of both sides are carried; their names must differ.
    """
    check(requests, "session string, started timestamp, requested timestamp", "frames_of_requests")
    check(frames, "session string, event_time timestamp", "frames_of_requests", "second input")
    seen = frames.withColumnRenamed("session", "frame_session")
    asked, at = F.col("requested"), F.col("event_time")
    within = (at <= asked) & (at >= asked - F.make_dt_interval(secs=F.lit(reach_seconds)))
    same = (F.col("session") == F.col("frame_session")) & within & (at >= F.col("started"))
    return requests.join(seen, same, "left").drop("frame_session")
