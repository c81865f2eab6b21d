"""Windowed archives of frames, as parquet or JSON files in partition folders."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.paths import join_path, typed_path, window_stem
from ..operators.nested import drop_images
from ..operators.windows import group_by_window, with_window

# Partition columns for each layout. `window` folders are named `<start>_<end>`.
LAYOUTS = {
    "session": ("datesegment", "session", "window"),
    "flat": ("session", "window"),
    "window": ("window",),
    "bucket": ("bucket", "window"),
}
#: Folders that the sessions of a window are dealt to in the `bucket` layout.
BUCKETS = 8


def session_bucket(session: Column, buckets: int = BUCKETS) -> Column:
    """The bucket of a session in the `bucket` layout."""
    return F.pmod(F.xxhash64(session), F.lit(buckets)).cast("int")


def write_windowed_archive(
    frames: DataFrame,
    base_path: str,
    period_seconds: int = 60,
    *,
    key: str = "session",
    layout: str = "session",
    fmt: str = "parquet",
    mode: str = "append",
    keep_images: bool = False,
    tasks: int | None = None,
    buckets: int = BUCKETS,
) -> None:
    """Write frames by key and window.

    The rows of a window meet in one task, hence one file, unless there are too many of them:
    the rebalance step splits an oversized window over several tasks. Use the ``window`` layout where
    one folder per session and minute would be too many; rows are sorted by session inside files. The ``bucket`` layout
    deals the sessions of a window to ``buckets`` folders, so there are as many files for few sessions as for many, and
    :func:`read_sessions` reads the folders of some sessions only; ``session`` and ``flat`` make a file per session and
    window, which grow in number with the sessions. The rebalance step goes by bytes; give a number of ``tasks`` where folders are so many and small that opening files takes the time.
    """
    rows = frames if keep_images else drop_images(frames)
    rows = with_window(rows, period_seconds).withColumn(
        "window", window_stem(F.col("window_start"), F.col("window_end"))
    )
    columns = LAYOUTS[layout]
    if key != "session":
        rows = rows.withColumnRenamed(key, "session")
    if "bucket" in columns:
        rows = rows.withColumn("bucket", session_bucket(F.col("session"), buckets))
    spread = (*(c for c in columns if c in ("session", "bucket")), "window_start")
    by = [F.col(c) for c in spread]
    (
        (rows.repartition(tasks, *by) if tasks else rows.hint("rebalance", *by))
        .sortWithinPartitions(*columns, "session", "event_time")
        .write.partitionBy(*columns)
        .format(fmt)
        .mode(mode)
        .save(base_path)
    )


def read_archive(spark: SparkSession, base_path: str, fmt: str = "parquet") -> DataFrame:
    """Archived frames; filters on the partition columns skip whole folders."""
    return spark.read.format(fmt).load(base_path)


def read_sessions(spark: SparkSession, base_path: str, *sessions: str, buckets: int = BUCKETS) -> DataFrame:
    """Archived frames of some sessions from the ``bucket`` layout; other buckets' folders are not read."""
    wanted = spark.range(1).select(*(session_bucket(F.lit(s), buckets) for s in sessions)).first()
    stored = read_archive(spark, base_path)
    return stored.where(F.col("bucket").isin(*set(wanted)) & F.col("session").isin(*sessions))


def compact_closed(spark: SparkSession, base_path: str, target: str, closed_before: int) -> None:
    """Write the windows of a frame job's archive that ended by ``closed_before`` (epoch seconds) to ``target``.

    The job writes a file per micro-batch, task and window; here a window has one file, unless it is too
    big for a task. Run again with a later time, it replaces the windows it writes and leaves others.
    """
    stored = read_archive(spark, base_path)
    end = F.substring_index("window", "_", -1).try_cast("bigint")
    (
        stored.where(end <= closed_before)
        .drop("batch_id")
        .hint("rebalance", F.col("window"))
        .sortWithinPartitions("window", "session", "event_time")
        .write.partitionBy("window")
        .option("partitionOverwriteMode", "dynamic")
        .mode("overwrite")
        .parquet(target)
    )


#: Bytes of a compacted file, about.
FILE_BYTES = 128 << 20
_FILES = "window string, path string, rows bigint, bytes bigint, sources array<string>"


def _snapshot_number(spark: SparkSession, target: str) -> int:
    """The number of the last snapshot that is complete, 0 without any."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(f"{target}/_snapshots/*/_SUCCESS")
    found = hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(hadoop) or []
    return max((int(f.getPath().getParent().getName()) for f in found), default=0)


def snapshot_files(spark: SparkSession, target: str, number: int | None = None) -> DataFrame:
    """The files of the last snapshot, or of one by its number, with their windows, rows, bytes and sources."""
    last = _snapshot_number(spark, target) if number is None else number
    if not last:
        return spark.createDataFrame([], _FILES)
    return spark.read.schema(_FILES).parquet(f"{target}/_snapshots/{last}")


def _copied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Copy the rows of each pack's source files to its one file, a batch of rows at a time."""
    import pyarrow.parquet as pq
    from pyarrow import fs

    def opened(uri: str):
        return fs.FileSystem.from_uri("file:///" + uri[5:].lstrip("/") if uri.startswith("file:/") else uri)

    def instants(batch: pa.RecordBatch) -> pa.RecordBatch:
        # Spark's timestamps are instants of microseconds.
        for k, field in enumerate(batch.schema):
            if pa.types.is_timestamp(field.type):
                column = batch.column(k).cast(pa.timestamp("us"), safe=False).cast(pa.timestamp("us", "UTC"))
                batch = batch.set_column(k, field.name, column)
        return batch

    for batch in batches:
        sizes, counts = [], []
        for target, sources in zip(batch.column("path").to_pylist(), batch.column("sources").to_pylist()):
            files, place = opened(target)
            files.create_dir(place.rsplit("/", 1)[0], recursive=True)
            writer, rows = None, 0
            for source in sources:
                store, name = opened(source)
                with store.open_input_file(name) as file:
                    for part in map(instants, pq.ParquetFile(file).iter_batches(1024)):
                        writer = writer or pq.ParquetWriter(place, part.schema, filesystem=files)
                        writer.write_batch(part)
                        rows += part.num_rows
            if writer:
                writer.close()
            counts.append(rows)
            sizes.append(files.get_file_info(place).size if writer else 0)
        columns = [batch.column("window"), batch.column("path"), pa.array(counts, pa.int64()), pa.array(sizes, pa.int64())]
        yield pa.RecordBatch.from_arrays([*columns, batch.column("sources")], ["window", "path", "rows", "bytes", "sources"])


def compact_snapshot(
    spark: SparkSession, base_path: str, target: str, closed_before: int, file_bytes: int = FILE_BYTES
) -> None:
    """Pack the files of an archive's windows that ended by ``closed_before`` into few files, as a new snapshot.

    Files are packed by size within their window, and a task copies a pack to one file, so neither rows nor images are
    shuffled. The snapshot is a list of files that is complete or not there: a reader sees the one before or this
    one, a job that fails leaves files that no list names, and a file of the archive that has been packed is not packed
    again. Files that come later for a window that was packed are packed by the next run.
    """
    done = snapshot_files(spark, target)
    stored = read_archive(spark, base_path)
    end = F.substring_index("window", "_", -1).try_cast("bigint")
    files = stored.where(end <= closed_before).select(
        F.col("window").cast("string").alias("window"),
        F.col("_metadata.file_path").alias("source"),
        F.col("_metadata.file_size").alias("size"),
    )
    # Of a file only its name and size are read.
    files = files.distinct().join(done.select(F.explode("sources").alias("source")), "source", "left_anti")
    in_order = Window.partitionBy("window").orderBy("source").rowsBetween(Window.unboundedPreceding, 0)
    packed = files.withColumn("pack", F.floor((F.sum("size").over(in_order) - 1) / file_bytes))
    packs = packed.groupBy("window", "pack").agg(F.sort_array(F.collect_list("source")).alias("sources"))
    number = _snapshot_number(spark, target) + 1
    folder = F.concat(F.lit(f"{target}/window="), "window", F.lit(f"/{uuid.uuid4().hex}-"), F.col("pack").cast("string"))
    packs = packs.select("window", F.concat(folder, F.lit(".parquet")).alias("path"), "sources")
    # Written first, so that a task that runs again copies the same pack to the same file.
    plan = f"{target}/_packs/{uuid.uuid4().hex}"
    packs.write.parquet(plan)
    packs = spark.read.parquet(plan).repartition(spark.sparkContext.defaultParallelism * 4, "path")
    copied = packs.mapInArrow(_copied, _FILES)
    done.unionByName(copied).write.parquet(f"{target}/_snapshots/{number}")


def read_snapshot(spark: SparkSession, target: str, number: int | None = None) -> DataFrame:
    """Archived frames of the last snapshot; a reader that has begun keeps the files it began with."""
    paths = [r.path for r in snapshot_files(spark, target, number).where("rows > 0").select("path").collect()]
    if not paths:
        raise ValueError(f"{target} has no snapshot with rows")
    return spark.read.option("basePath", target).parquet(*paths)


def archived_paths(spark: SparkSession, base_path: str, *keys: str, fmt: str = "parquet") -> DataFrame:
    """What was written: each folder of the archive, by its path below ``base_path``, with its rows.

    ``keys`` are columns to count by inside a folder, such as the session. No contents are read but these.
    """
    stored = read_archive(spark, base_path, fmt)
    # The path is a URI, in which the escapes of folder names are escaped again.
    folder = F.url_decode(F.regexp_extract("_metadata.file_path", r"((?:[^/]+=[^/]+/)+)[^/]+$", 1))
    return stored.select(folder.alias("folder"), *keys).groupBy("folder", *keys).agg(F.count("*").alias("n_frames"))


def archive_manifest(
    frames: DataFrame,
    period_seconds: int,
    *,
    bucket: Column | str,
    base_path: Column | str,
    module: Column | str,
    ext: str = "tfrecord",
    suffix: str = ".tfrecords.gz",
    protocol: str = "gs://",
) -> DataFrame:
    """One row per session and window: its file path and row count.

    The date part of the path comes from the first frame of the window.
    """
    first = F.min(F.struct("event_time", "frame_id", "datesegment")).alias("first")
    groups = group_by_window(frames, "session", period_seconds, F.count("*").alias("n_frames"), first)
    filename = F.concat(window_stem(F.col("window_start"), F.col("window_end")), F.lit(suffix))
    path = typed_path(
        bucket, base_path, F.col("session"), F.col("first.datesegment"), module, ext, filename, protocol
    )
    return groups.select("session", "window_start", "window_end", "n_frames", path.alias("path"))


def parquet_window_path(base_path: Column | str, key: Column, window_start: Column, window_end: Column, record_type: str = "parquet") -> Column:
    """``<base>/<key>/<record_type>/<start>_<end>.parquet``."""
    stem = window_stem(window_start, window_end)
    return join_path(base_path, key, record_type, F.concat(stem, F.lit(".parquet")))
