"""What a streaming query holds in its checkpoint, and whether a job that takes its place may go on from there."""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..functions.paths import window_bounds

#: Folder of a checkpoint that has the options its query was first started with.
OPTIONS = "job-options"


class ChangedJob(ValueError):
    """A job whose options or columns are not those that the state of its checkpoint was made with."""


# --- open windows --------------------------------------------------------------------------------


def _held(spark: SparkSession, checkpoint: str, operator: int) -> DataFrame:
    """The keys and values of a stateful operator as of the last committed batch, read by partition on the executors."""
    return spark.read.format("statestore").option("operatorId", operator).load(checkpoint)


def _buffers(found: list[T.StructField], names: tuple[str, ...]) -> T.StructType:
    """The fields of a value under ``names``; Spark calls them by their functions, so names may repeat."""
    if len(found) != len(names):
        raise ValueError(f"the state has {len(found)} values, {', '.join(f.name for f in found)}, not {len(names)}")
    return T.StructType([T.StructField(name, f.dataType) for name, f in zip(names, found)])


def open_windows(spark: SparkSession, checkpoint: str, *names: str, operator: int = 0) -> DataFrame:
    """The windows that an aggregation by ``window`` holds: their keys, bounds and the aggregates so far.

    ``names`` are those of the aggregates, in their order; an average takes two, its sum and its count. Of aggregations
    in a chain, ``operator`` tells which one, the last is 0.
    """
    held = _held(spark, checkpoint, operator)
    keys, values = held.schema["key"].dataType, held.schema["value"].dataType
    buffers = _buffers(values.fields, names)
    own = [F.col(f"key.`{k}`") for k in keys.names if k != "window"]
    rows = held.select(*own, *window_bounds(F.col("key.window")), F.col("value").cast(buffers).alias("value"))
    return rows.select(*(c for c in rows.columns if c != "value"), "value.*")


def open_sessions(spark: SparkSession, checkpoint: str, *names: str, operator: int = 0) -> DataFrame:
    """The sessions that an aggregation by ``session_window`` holds, with their keys, bounds and aggregates so far.

    Bounds are those of :func:`framekeel.streaming.windows.session_latest`, whose aggregates are the number of rows and
    the latest row.
    """
    held = _held(spark, checkpoint, operator)
    fields = held.schema["value"].dataType.fields
    at = [f.name for f in fields].index("session_window")
    named = _buffers(fields[at + 1 :], names)
    whole = T.StructType([*fields[:at], T.StructField("_window", fields[at].dataType), *named.fields])
    rows = held.select(F.col("value").cast(whole).alias("value")).select("value.*")
    end = F.timestamp_micros(F.unix_micros("_window.end") + 1)
    bounds: list[Column] = [F.col("_window.start").alias("session_start"), end.alias("session_end")]
    return rows.select(*(f.name for f in fields[:at]), *bounds, *names)


# --- a job in the place of another one -----------------------------------------------------------


def _described(df: DataFrame, options: Mapping) -> dict[str, dict[str, str]]:
    columns = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    return {"option": {name: str(value) for name, value in options.items()}, "column": columns}


def _recorded(spark: SparkSession, checkpoint: str) -> dict[str, dict[str, str]] | None:
    try:
        rows = spark.read.schema("value string").text(f"{checkpoint}/{OPTIONS}").take(1)
    except AnalysisException as problem:
        if problem.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    return json.loads(rows[0]["value"]) if rows else None


def check_options(df: DataFrame, checkpoint: str, options: Mapping) -> bool:
    """Raise :class:`ChangedJob` if ``checkpoint`` was made with other options or columns; whether it has any.

    The error names each option and column that differs, with both values. A checkpoint without a record is taken as it
    is, which a first start needs.
    """
    before = _recorded(df.sparkSession, checkpoint)
    if before is None:
        return False
    now = _described(df, options)
    changed = [
        f"{kind} {name} is {now[kind].get(name, 'missing')}, was {before[kind].get(name, 'missing')}"
        for kind in now
        for name in sorted(now[kind].keys() | before[kind].keys())
        if now[kind].get(name) != before[kind].get(name)
    ]
    if changed:
        raise ChangedJob(f"{checkpoint} holds the state of another job: {'; '.join(changed)}. Go on as before, or start anew")
    return True


def keep_options(df: DataFrame, checkpoint: str, options: Mapping) -> None:
    """:func:`check_options`, and note down ``options`` and the columns of ``df`` at the first start."""
    if not check_options(df, checkpoint, options):
        spark, note = df.sparkSession, json.dumps(_described(df, options))
        spark.createDataFrame([(note,)], "value string").coalesce(1).write.mode("overwrite").text(f"{checkpoint}/{OPTIONS}")


def replace(
    running: StreamingQuery, df: DataFrame, checkpoint: str, options: Mapping, start: Callable[[], StreamingQuery]
) -> StreamingQuery:
    """Stop ``running`` and ``start`` the job that goes on from its checkpoint.

    The options are checked first, so a job that is refused leaves the running one as it is. A batch that the stop cuts
    off comes again, as after any failure.
    """
    check_options(df, checkpoint, options)
    running.stop()
    return start()
