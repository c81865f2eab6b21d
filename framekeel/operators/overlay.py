"""What to draw on each frame and where the drawn frame goes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.paths import typed_path
from .nested import drawable, effective_annotations, overlay_boxes


def frame_path(
    bucket: Column | str,
    base_path: Column | str,
    module: Column | str,
    ext: str = "jpg",
    protocol: str = "gs://",
) -> Column:
    """Path of a frame file, named by its ``ts``."""
    name = F.concat(F.col("ts").cast("string"), F.lit(f".{ext}"))
    return typed_path(
        bucket, base_path, F.col("session"), F.col("datesegment"), module, ext, name, protocol
    )


def overlay_plans(
    frames: DataFrame,
    *,
    bucket: str,
    base_path: str,
    module: str,
    max_boxes: int | None = 10,
    min_score: float = 0.5,
    protocol: str = "gs://",
    **drawing,
) -> DataFrame:
    """Add ``overlay``, one element per box location, and ``outpath`` to annotated frames.

    ``drawing`` are options of :func:`framekeel.operators.nested.overlay_boxes`.
    """
    drawn = drawable(F.col("effective.detections"), max_boxes, min_score)
    marked = effective_annotations(frames).withColumn("drawn", drawn)
    return (
        overlay_boxes(marked, **drawing)
        .withColumn("outpath", frame_path(bucket, base_path, module, "jpg", protocol))
        .drop("effective", "drawn")
    )


def frame_overlays(
    frames: DataFrame, *, image: str = "image_data", **options
) -> tuple[DataFrame, DataFrame]:
    """Overlay plan and output path of every frame with an image, and the frames that have none.

    ``frames`` carry ``annotations_all`` and ``annotations_filtered``; ``options`` are those of
    :func:`overlay_plans`. The image itself is only tested for being there.
    """
    has_image = F.coalesce(F.octet_length(image) > 0, F.lit(False))
    plans = overlay_plans(frames.where(has_image).drop(image), **options)
    return plans, frames.where(~has_image).drop(image)


def manifest(plans: DataFrame, *carry: str) -> DataFrame:
    """The key and path of every written frame."""
    return plans.select("session", "outpath", *carry)
