"""Operators on frames that carry their detections as an array. None of them shuffles."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..contracts import transform
from ..functions import BoxCols, box_color, display_label, health_weight, percent_intersection
from .asof import asof_join

MIN_OVERLAP = 0.75
IMAGE_COLUMNS = ("image_data", "image_tensor")


def drop_images(frames: DataFrame) -> DataFrame:
    """Drop image payloads; do this before anything that shuffles."""
    return frames.drop(*IMAGE_COLUMNS)


def annotations(detections: Column, strict: bool = False) -> Column:
    """Annotation struct: the detections with their health weights, and how many there are."""

    def annotated(found: Column) -> Column:
        weighted = F.transform(
            found, lambda d: d.withField("health_weight", health_weight(d["class"], strict))
        )
        return F.struct(
            F.coalesce(F.size(found), F.lit(0)).alias("num_detections"), weighted.alias("detections")
        )

    # Through a list of one, an array that is itself the result of work is worked out once.
    return F.transform(F.array(detections), annotated)[0]


def keep_in_area(detections: Column, area: BoxCols, min_overlap: float = MIN_OVERLAP) -> Column:
    """Detections whose overlap with the area is above ``min_overlap``."""
    return F.filter(
        detections,
        lambda d: percent_intersection(BoxCols.of_struct(d), area) > min_overlap,
    )


def join_calibration(frames: DataFrame, calibrations: DataFrame) -> DataFrame:
    """Add the calibrated area of each frame's device, null where there is none.

    Calibrations with ``valid_from`` are versions: each frame gets the one that was in force at its ``ts``. Spark broadcasts the calibrations while they are below its size threshold and shuffles on the
    device beyond it, so no hint is given here.
    """
    if "valid_from" in calibrations.columns:
        return asof_join(frames, calibrations, ["device_id"])
    return frames.join(calibrations, "device_id", "left")


@transform(
    needs="device_id int, detections array<struct<class:int,score:double,ymin:double,xmin:double,ymax:double,xmax:double>>",
    gives="annotations_all struct<num_detections:int>, annotations_filtered struct<num_detections:int>",
)
def merge_filtered(
    frames: DataFrame, calibrations: DataFrame, min_overlap: float = MIN_OVERLAP
) -> DataFrame:
    """Add ``annotations_all`` and, for calibrated devices, ``annotations_filtered``."""
    area = BoxCols.of_columns("c_")
    filtered = annotations(keep_in_area(F.col("detections"), area, min_overlap))
    return (
        join_calibration(frames, calibrations)
        .withColumn("annotations_all", annotations(F.col("detections")))
        .withColumn("annotations_filtered", F.when(area.ymin.isNotNull(), filtered))
    )


@transform(
    needs="annotations_all struct<num_detections:int>, annotations_filtered struct<num_detections:int>",
    gives="effective struct<num_detections:int>",
)
def effective_annotations(frames: DataFrame) -> DataFrame:
    """Add ``effective``: the filtered annotations if any detection is left, otherwise all."""
    use_filtered = F.coalesce(F.col("annotations_filtered.num_detections") > 0, F.lit(False))
    return frames.withColumn(
        "effective",
        F.when(use_filtered, F.col("annotations_filtered")).otherwise(F.col("annotations_all")),
    )


def drawable(detections: Column, max_boxes: int | None = 20, min_score: float = 0.5) -> Column:
    """The first ``max_boxes`` detections by position, of these the ones above ``min_score``.

    Without ``max_boxes`` all detections qualify; a detection without a score always does, one whose
    score is not a number never.
    """
    first = F.slice(detections, 1, max_boxes) if max_boxes else detections
    return F.filter(first, lambda d: is_drawn(d["score"], min_score))


def is_drawn(score: Column, min_score: float) -> Column:
    """Whether a box among the first ones is drawn."""
    return score.isNull() | ((score > min_score) & ~F.isnan(score))


def overlay_boxes(
    frames: DataFrame,
    drawn: str = "drawn",
    *,
    agnostic: bool = False,
    skip_labels: bool = False,
    skip_scores: bool = False,
    track_ids: bool = False,
    ignored: Callable[[Column], Column] | None = None,
) -> DataFrame:
    """Add ``overlay``: per box location its labels in position order and the colour of the last box.

    Without scores, as in ground truth, boxes have no labels and one colour. With ``track_ids``,
    detections have a ``track_id`` that goes into labels and colours. With ``ignored``, a condition on a
    detection, the flag of the last box at a location marks all its labels.
    """

    def location(d: Column) -> Column:
        return F.struct(*(d[n].alias(n) for n in BoxCols._fields))

    def placed(d: Column, i: Column) -> Column:
        return F.struct(location(d).alias("place"), i.alias("at"))

    def group(start: Column, end: Column) -> Column:
        """The boxes of a run of equal places, in order of position."""
        # Through a list of one, the run is cut out once.
        run = F.array(F.slice("_sorted", start + 1, end - start))

        def of_run(r: Column) -> Column:
            same = F.transform(r, lambda b: F.get(drawn, b["at"]))
            return F.struct(r[0]["at"].alias("at"), r[0]["place"].alias("place"), same.alias("same"))

        return F.transform(run, of_run)[0]

    def marked(group: Column) -> Column:
        scored = F.filter(group["same"], lambda d: d["score"].isNotNull())
        last = F.try_element_at(group["same"], F.lit(-1))
        flag = F.coalesce(ignored(last), F.lit(False)) if ignored else F.lit(False)

        def label(d: Column) -> Column:
            text = display_label(
                d["class"],
                d["score"],
                d["track_id"] if track_ids else None,
                skip_labels=skip_labels,
                skip_scores=skip_scores,
                agnostic=agnostic,
            )
            return F.concat(text, F.when(flag, F.lit(" (ignored)")).otherwise("")) if ignored else text

        track = last["track_id"] if track_ids else None
        return F.struct(
            *(group["place"][n].alias(n) for n in BoxCols._fields),
            F.transform(scored, label).alias("labels"),
            box_color(last["class"], last["score"], track, agnostic=agnostic).alias("color"),
            flag.alias("ignored"),
        )

    # Sorted by place and position, equal places are runs: each box is looked at once, however many places there are.
    n = F.size("_sorted")

    def opens(i: Column) -> Column:
        return (i == 0) | ~F.get("_sorted", i)["place"].eqNullSafe(F.get("_sorted", i - 1)["place"])

    starts = F.filter(F.sequence(F.lit(0), F.greatest(n - 1, F.lit(0))), lambda i: (i < n) & opens(i))
    runs = F.transform("_starts", lambda start, k: group(start, F.coalesce(F.get("_starts", k + 1), n)))
    # In order of the first box of each place.
    return (
        frames.withColumn("_sorted", F.array_sort(F.transform(drawn, placed)))
        .withColumn("_starts", starts)
        .withColumn("overlay", F.transform(F.array_sort(runs), marked))
        .drop("_sorted", "_starts")
    )


@transform(
    needs="ts bigint, session string, detections array<struct<pos:int,class:int,score:double>>",
    gives="detection_class int, detection_score double, health_weight double, health_score double",
)
def explode_detections(frames: DataFrame, *keep: str) -> DataFrame:
    """One row per detection with its health weight and score; frames without detections vanish."""
    weight = health_weight(F.col("d.class"))
    return frames.select(
        "ts", "session", *keep, F.explode("detections").alias("d")
    ).select(
        "ts",
        "session",
        *keep,
        F.col("d.pos").alias("pos"),
        F.col("d.class").alias("detection_class"),
        F.col("d.score").alias("detection_score"),
        weight.alias("health_weight"),
        (weight * F.col("d.score")).alias("health_score"),
    )


def postprocess(
    boxes: Column,
    classes: Column,
    scores: Column,
    count: Column,
    *,
    cut_to_count: bool = False,
    strict: bool = False,
) -> Column:
    """Raw model output of an image to annotations: class ids start at 1, boxes become structs.

    The arrays keep their full length unless ``cut_to_count``; ``num_detections`` is the model's count. No output
    stops a job: a class that is no number, or too large, is null, which is unknown; a count that is none, or below
    0, counts as 0, and one above the number of boxes as that number; a list that is too short is filled with nulls.
    """
    def made(rows: Column) -> Column:
        number = F.nanvl(F.coalesce(count.cast("double"), F.lit(0.0)), F.lit(0.0))
        size = F.coalesce(F.size(rows), F.lit(0)).cast("double")
        n = F.greatest(F.least(number, size), F.lit(0.0)).cast("int")

        def detection(r: Column, i: Column) -> Column:
            label = F.try_add(r["c"].try_cast("int"), F.lit(1))
            return F.struct(
                (i + 1).cast("int").alias("pos"),
                label.alias("class"),
                r["s"].cast("double").alias("score"),
                *(F.get(r["b"], F.lit(k)).cast("double").alias(n) for k, n in enumerate(BoxCols._fields)),
                health_weight(label, strict).alias("health_weight"),
            )

        counted = F.slice(rows, F.lit(1), n) if cut_to_count else rows
        return F.struct(n.alias("num_detections"), F.transform(counted, detection).alias("detections"))

    # Through a list of one, the zipped lists are worked out once.
    return F.transform(F.array(F.arrays_zip(boxes.alias("b"), classes.alias("c"), scores.alias("s"))), made)[0]
