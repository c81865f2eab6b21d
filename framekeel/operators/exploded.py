"""Operators on detections kept one per row.

They aggregate and rank instead of collecting a frame's detections, so a frame with very many of
them is spread over tasks. Rows carry ``frame_id``, ``class``, ``score``, the box and, where a
calibration was joined, its area in ``c_*`` columns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import BoxCols, box_color, category_table, display_label, health_weight, percent_intersection
from .nested import MIN_OVERLAP, is_drawn


def with_overlap(detections: DataFrame, min_overlap: float = MIN_OVERLAP) -> DataFrame:
    """Add ``overlap`` and ``kept``; both are null on devices without a calibration."""
    overlap = percent_intersection(BoxCols.of_columns(), BoxCols.of_columns("c_"))
    return detections.withColumn("overlap", overlap).withColumn(
        "kept", F.col("overlap") > min_overlap
    )


def join_categories(detections: DataFrame) -> DataFrame:
    """Name and health weight of every detection; the category table has six rows, so it is broadcast."""
    categories = category_table(detections.sparkSession)
    return (
        detections.join(F.broadcast(categories), "class", "left")
        .withColumn("name", F.coalesce("name", F.lit("N/A")))
    )


def annotation_counts(frames: DataFrame, detections: DataFrame) -> DataFrame:
    """Per frame: detections, kept detections (null without calibration) and what is effective.

    ``detections`` comes from :func:`with_overlap`. Frames without detections stay, through a union
    of zero rows rather than an outer join. The effective set is the kept one if not empty.
    """
    calibrated = F.col("c_ymin").isNotNull()
    zero = frames.select(
        "frame_id",
        F.lit(0).alias("seen"),
        F.when(calibrated, 0).alias("kept"),
        F.lit(None).cast("double").alias("score"),
    )
    rows = detections.select(
        "frame_id", F.lit(1).alias("seen"), F.col("kept").cast("int").alias("kept"), "score"
    )
    kept_score = F.when(F.col("kept") == 1, F.col("score"))
    per_frame = (
        zero.unionByName(rows)
        .groupBy("frame_id")
        .agg(
            F.sum("seen").alias("num_all"),
            F.sum("kept").alias("num_filtered"),
            F.max("score").alias("max_all"),
            F.max(kept_score).alias("max_filtered"),
        )
    )
    use_filtered = F.coalesce(F.col("num_filtered") > 0, F.lit(False))
    return per_frame.select(
        "frame_id",
        "num_all",
        "num_filtered",
        F.when(use_filtered, "filtered").otherwise("all").alias("source"),
        F.when(use_filtered, F.col("num_filtered")).otherwise(F.col("num_all")).alias("num_effective"),
        F.when(use_filtered, F.col("max_filtered")).otherwise(F.col("max_all")).alias("max_score"),
    )


def drawable(
    detections: DataFrame,
    order: list[str],
    max_boxes: int | None = 20,
    min_score: float = 0.5,
    *,
    effective: bool = False,
) -> DataFrame:
    """First ``max_boxes`` detections of each frame in ``order``, of these the ones above ``min_score``.

    With ``effective``, frames with kept detections draw only those, others draw all. Spark cuts each
    frame to ``max_boxes`` rows before the shuffle, so a hot frame stays small. Without a limit all
    detections qualify; one without a score always does, one whose score is not a number never.
    Adds ``pos``.
    """
    first = F.col("pos") <= max_boxes if max_boxes else F.lit(True)
    if effective:
        # These rows come from a join on the frame. Partitioning by another form of its id makes Spark
        # shuffle for the ranking, and so cut the frames before that, in the tasks of the join.
        frame = F.struct("frame_id")
        dropped = ~F.coalesce(F.col("kept"), F.lit(False))
        ranked = Window.partitionBy(frame).orderBy(dropped, *order)
        first_dropped = F.first(dropped).over(ranked.rowsBetween(Window.unboundedPreceding, 0))
        rows = (
            detections.select(
                "*", F.row_number().over(ranked).alias("pos"), first_dropped.alias("first_dropped")
            )
            .where(first)
            .where(dropped == F.col("first_dropped"))
            .drop("first_dropped")
        )
    else:
        ranked = Window.partitionBy("frame_id").orderBy(*order)
        rows = detections.withColumn("pos", F.row_number().over(ranked)).where(first)
    return rows.where(is_drawn(F.col("score"), min_score))


def by_location(drawn: DataFrame, *carry: str, ignored: Column | None = None) -> DataFrame:
    """One row per frame and box location: labels in position order, colour of the last one.

    Takes the output of :func:`drawable`, so a group holds at most ``max_boxes`` rows. A box without
    a score has no label and its own colour. With ``ignored``, the flag of the last box at a location
    marks all its labels.
    """
    rows = drawn.select(
        "frame_id",
        *carry,
        *BoxCols._fields,
        "pos",
        F.when(F.col("score").isNotNull(), display_label(F.col("class"), F.col("score"))).alias("label"),
        box_color(F.col("class"), F.col("score")).alias("color"),
        (ignored if ignored is not None else F.lit(False)).alias("ignored"),
    )
    places = rows.groupBy("frame_id", *carry, *BoxCols._fields).agg(
        F.sort_array(F.collect_list(F.struct("pos", "label", "color", "ignored"))).alias("boxes")
    )
    last = F.element_at("boxes", -1)
    suffix = F.when(last["ignored"], F.lit(" (ignored)")).otherwise(F.lit(""))
    return places.select(
        "frame_id",
        *carry,
        *BoxCols._fields,
        F.array_compact(F.transform("boxes", lambda b: F.concat(b["label"], suffix))).alias("labels"),
        last["color"].alias("color"),
        last["ignored"].alias("ignored"),
    )


def health_rows(detections: DataFrame, *carry: str) -> DataFrame:
    """Weight and health score of every detection."""
    weight = health_weight(F.col("class"))
    return detections.select(
        *carry,
        F.col("class").alias("detection_class"),
        F.col("score").alias("detection_score"),
        weight.alias("health_weight"),
        (weight * F.col("score")).alias("health_score"),
    )
