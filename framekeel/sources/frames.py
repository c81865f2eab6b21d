"""Frame files of a session."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


#: The columns of packs.
PACK = "path string, length bigint, modificationTime timestamp, content binary"


def list_frames(spark: SparkSession, session_path: str, ext: str = "jpg", *, packed: bool = False) -> DataFrame:
    """Paths of the frame files below ``<session_path>/<ext>/``, with ``ts`` from the file name.

    File contents are not read, and empty files are not listed. With ``packed``, these are the frames in the packs that
    :func:`pack_frames` wrote to that folder; use packs for whole archives, as the driver lists files one by one.
    """
    folder = f"{session_path.rstrip('/')}/{ext}"
    if packed:
        files = spark.read.schema(PACK).parquet(folder).where(F.col("path").endswith(f".{ext}") & (F.col("length") > 0))
    else:
        files = spark.read.format("binaryFile").option("pathGlobFilter", f"*.{ext}").load(folder)
    files = files.select("path", "length", "modificationTime")
    stem = F.regexp_extract("path", r"/([0-9]+)\.[^/.]+$", 1)
    return files.withColumn("ts", stem.try_cast("bigint"))


def pack_frames(frames: DataFrame, folder: str, path: str = "path", image: str = "image_data") -> None:
    """Write each row's ``image`` bytes under the name that ``path`` gives to packs, parquet files below a new ``folder``.

    A file system keeps a block and an entry for each file, however small; a pack holds as many frames as a task has, and
    their names and lengths are read without the images. Rows without an image or path are left out.
    """
    data = F.col(image).cast("binary")
    packed = frames.select(
        F.col(path).alias("path"),
        F.octet_length(data).cast("bigint").alias("length"),
        F.current_timestamp().alias("modificationTime"),
        data.alias("content"),
    )
    packed.where(F.col("path").isNotNull() & F.col("content").isNotNull()).write.parquet(folder)


def write_frames(frames: DataFrame, path: str = "path", image: str = "image_data") -> DataFrame:
    """Write each row's ``image`` bytes to the file ``path`` names, in the tasks; give paths and lengths back.

    The files are written when the result is read. A task that is run again writes its files once more, so each file
    is whole. Rows without an image or path are left out. A path is a URI of any file system that Arrow knows.
    """

    def written(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        for batch in batches:
            lengths, made = [], set()
            for target, data in zip(batch.column(path).to_pylist(), batch.column(image)):
                uri = "file:///" + target[5:].lstrip("/") if target.startswith("file:/") else target
                files, place = fs.FileSystem.from_uri(uri)
                folder = place.rsplit("/", 1)[0]
                if folder not in made:
                    files.create_dir(folder, recursive=True)
                    made.add(folder)
                with files.open_output_stream(place) as file:
                    file.write(data.as_buffer())
                lengths.append(len(data.as_buffer()))
            columns = [batch.column(path), pa.array(lengths, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["path", "length"])

    rows = frames.select(path, F.col(image).cast("binary").alias(image)).where(F.col(path).isNotNull() & F.col(image).isNotNull())
    return rows.mapInArrow(written, "path string, length bigint")
