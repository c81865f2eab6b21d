"""Start streaming queries and write micro-batches so that a replay does no harm."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

# Work off what is there, then stop. Started again on the same checkpoint, a query goes on.
DRAIN = {"availableNow": True}


def to_files(
    df: DataFrame, path: str, checkpoint: str, *, fmt: str = "parquet", trigger: dict | None = None
) -> StreamingQuery:
    """Append a stream to files, each row exactly once."""
    return (
        df.writeStream.format(fmt)
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or DRAIN))
        .start()
    )


def each_batch(
    df: DataFrame,
    write: Callable[[DataFrame, int], None],
    checkpoint: str,
    *,
    trigger: dict | None = None,
    output_mode: str = "append",
) -> StreamingQuery:
    """Call ``write(batch, batch_id)`` for every micro-batch."""
    return (
        df.writeStream.foreachBatch(write)
        .outputMode(output_mode)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or DRAIN))
        .start()
    )


def batch_path(base: str, batch_id: int) -> str:
    """Folder of one micro-batch. Written in overwrite mode, a replayed batch replaces itself."""
    return f"{base.rstrip('/')}/batch_id={batch_id}"
