"""Box geometry. Coordinates are always in the order ymin, xmin, ymax, xmax."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column
from pyspark.sql import functions as F


class BoxCols(NamedTuple):
    """The four coordinates of a box as columns."""

    ymin: Column
    xmin: Column
    ymax: Column
    xmax: Column

    @classmethod
    def of_struct(cls, struct: Column) -> BoxCols:
        return cls(*(struct[n] for n in cls._fields))

    @classmethod
    def of_columns(cls, prefix: str = "") -> BoxCols:
        return cls(*(F.col(prefix + n) for n in cls._fields))

    @classmethod
    def of_values(cls, values) -> BoxCols:
        return cls(*(F.lit(float(v)) for v in values))


def percent_intersection(box: BoxCols, area: BoxCols) -> Column:
    """Share of ``box`` that lies inside ``area``: intersection divided by the area of ``box``.

    Boxes that are apart give 0, and so does a box without any area, or with a coordinate that is not
    a number. A missing area gives null.
    """
    nothing = F.lit(0.0)
    height = F.greatest(F.least(area.ymax, box.ymax) - F.greatest(area.ymin, box.ymin), nothing)
    width = F.greatest(F.least(area.xmax, box.xmax) - F.greatest(area.xmin, box.xmin), nothing)
    box_area = F.abs((box.ymax - box.ymin) * (box.xmax - box.xmin))
    # Spark puts NaN above all numbers, so it must not reach a comparison.
    share = F.nanvl(F.coalesce(F.try_divide(height * width, box_area), nothing), nothing)
    return F.when(area.ymin.isNotNull(), share)


def arrays_to_boxes(ymin: Column, xmin: Column, ymax: Column, xmax: Column) -> Column:
    """Four coordinate arrays to one array of box structs."""
    zipped = F.arrays_zip(
        ymin.alias("ymin"), xmin.alias("xmin"), ymax.alias("ymax"), xmax.alias("xmax")
    )
    return F.transform(
        zipped,
        lambda b: F.struct(
            b["ymin"].cast("double").alias("ymin"),
            b["xmin"].cast("double").alias("xmin"),
            b["ymax"].cast("double").alias("ymax"),
            b["xmax"].cast("double").alias("xmax"),
        ),
    )


def boxes_to_arrays(boxes: Column) -> dict[str, Column]:
    """The inverse: one array column per coordinate."""
    return {n: boxes[n] for n in BoxCols._fields}
