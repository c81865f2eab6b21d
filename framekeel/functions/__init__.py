"""Column functions. All are built from Spark expressions, so they run inside the JVM."""

from .boxes import BoxCols, arrays_to_boxes, boxes_to_arrays, percent_intersection
from .labels import (
    CATEGORIES,
    PALETTE,
    box_color,
    category_name,
    category_table,
    display_label,
    health_weight,
)
from .paths import typed_path, window_bounds

__all__ = [
    "BoxCols",
    "CATEGORIES",
    "PALETTE",
    "arrays_to_boxes",
    "box_color",
    "boxes_to_arrays",
    "category_name",
    "category_table",
    "display_label",
    "health_weight",
    "percent_intersection",
    "typed_path",
    "window_bounds",
]
