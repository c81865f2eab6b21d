"""Rows behind the watermark, kept in a table of their own with how late they were."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from . import runner

KEPT, LATE, MARKS = "kept", "late", "marks"


def split_late(
    rows: DataFrame, out: str, checkpoint: str, delay_seconds: int = 0, trigger: dict | None = None
) -> StreamingQuery:
    """Write rows in time to ``<out>/kept`` and those behind the watermark to ``<out>/late``, each once.

    The watermark is Spark's: the greatest event time of the micro-batches before, in whole milliseconds, less the
    delay; a row at or before it is late. It is written per micro-batch, so a replayed batch is judged alike. Rows
    without event time are in time. Late rows have ``watermark`` and ``late_ms``, how far they are behind it.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        before = None
        if batch_id:
            mark = spark.read.schema("mark_ms bigint").parquet(runner.batch_path(f"{out}/{MARKS}", batch_id - 1))
            before = mark.first()["mark_ms"]
        millis = F.unix_millis("event_time")
        # The first row of the micro-batch decides nothing: its watermark comes from the batches before.
        top = batch.agg(F.max(millis).alias("mark_ms"))
        so_far = F.greatest(F.col("mark_ms"), F.lit(before).cast("bigint")).alias("mark_ms")
        top.select(so_far).coalesce(1).write.mode("overwrite").parquet(runner.batch_path(f"{out}/{MARKS}", batch_id))
        watermark = F.lit(None if before is None else before - delay_seconds * 1000).cast("bigint")
        behind = F.coalesce(F.unix_micros("event_time") <= watermark * 1000, F.lit(False))
        marked = batch.withColumn("watermark", F.timestamp_millis(watermark)).withColumn("late_ms", watermark - millis)
        batch.where(~behind).write.mode("overwrite").parquet(runner.batch_path(f"{out}/{KEPT}", batch_id))
        marked.where(behind).write.mode("overwrite").parquet(runner.batch_path(f"{out}/{LATE}", batch_id))

    return runner.each_batch(rows, write, checkpoint, trigger=trigger)
