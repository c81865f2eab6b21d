"""Calibrated areas per device."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.boxes import BoxCols
from ..schemas import CALIBRATION_FILE


def read_calibrations(spark: SparkSession, base_path: str, filename: str = "calibration.json") -> DataFrame:
    """Calibrations from ``<base>/<device_id>/calibration.json`` as ``(device_id, c_*, fps)``.

    A device without a file has no row, and without any file there are no rows. The folder names the
    device, also when a Spark job wrote it partitioned by ``device_id``; ``filename`` may be a pattern.
    """
    reader = spark.read.schema(CALIBRATION_FILE).option("multiLine", True)
    try:
        files = reader.json(f"{base_path.rstrip('/')}/*/{filename}")
    except AnalysisException as problem:
        if problem.getCondition() != "PATH_NOT_FOUND":
            raise
        none = spark.createDataFrame([], CALIBRATION_FILE)
        files = none.withColumn("_metadata", F.struct(F.lit("").alias("file_path")))
    device = F.regexp_extract("_metadata.file_path", r"/(?:device_id=)?([0-9]+)/[^/]+$", 1).try_cast("int")
    corners = (F.get(F.col("box.xy"), F.lit(i)).alias("c_" + n) for i, n in enumerate(BoxCols._fields))
    return files.select(device.alias("device_id"), *corners, "fps")


VERSIONS = "device_id int, valid_from bigint, c_ymin double, c_xmin double, c_ymax double, c_xmax double, fps double"


def record_versions(
    spark: SparkSession, base_path: str, table: str, valid_from: int, filename: str = "calibration.json"
) -> None:
    """Append the calibrations below ``base_path`` that differ from a device's last version in ``table``.

    They count from ``valid_from`` (epoch seconds) on. Frames are joined with the table, so a job lists no folder per
    device, and a replayed micro-batch finds the versions of its time whatever has been calibrated since.
    """
    now = read_calibrations(spark, base_path, filename)
    values = [c for c in now.columns if c != "device_id"]
    last = F.max_by(F.struct(*values), "valid_from").alias("last")
    known = read_versions(spark, table).where(F.col("valid_from") <= valid_from).groupBy("device_id").agg(last)
    changed = now.join(known, "device_id", "left").where(~F.struct(*values).eqNullSafe(F.col("last")))
    version = changed.select("device_id", F.lit(valid_from).cast("bigint").alias("valid_from"), *values)
    # Whole before it is visible, and small.
    version.coalesce(1).write.mode("append").parquet(table)


def read_versions(spark: SparkSession, table: str) -> DataFrame:
    """All versions of the calibrations; none if nothing has been recorded."""
    try:
        return spark.read.schema(VERSIONS).parquet(table)
    except AnalysisException as problem:
        if problem.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], VERSIONS)
