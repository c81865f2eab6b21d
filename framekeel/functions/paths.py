"""Output paths and window bounds as columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def join_path(*parts: Column | str) -> Column:
    """Join path parts with single slashes; a part that already ends in ``/`` gets none added.

    An empty last part leaves a trailing slash. Only the first part may be absolute.
    """
    pieces = []
    for i, part in enumerate(parts):
        inner, last = i > 0, i == len(parts) - 1
        if isinstance(part, str):
            if inner and part.startswith("/"):
                raise ValueError(f"absolute path part: {part}")
            pieces.append(F.lit(part if last or part == "" or part.endswith("/") else part + "/"))
            continue
        piece = part
        if not last:
            bare = (part == "") | part.endswith("/")
            piece = F.when(bare, part).otherwise(F.concat(part, F.lit("/")))
        if inner:
            problem = F.concat(F.lit("absolute path part: "), part)
            piece = F.when(part.startswith("/"), F.raise_error(problem)).otherwise(piece)
        pieces.append(piece)
    return F.concat(*pieces)


def typed_path(
    bucket: Column | str,
    base_path: Column | str,
    key: Column | str,
    datesegment: Column | str,
    module: Column | str,
    ext: Column | str,
    filename: Column | str = "",
    protocol: Column | str = "gs://",
) -> Column:
    """``<protocol><bucket>/<base_path>/<module>/<datesegment>/<key>/<ext>/<filename>``."""
    return join_path(protocol, bucket, base_path, module, datesegment, key, ext, filename)


def window_bounds(window: Column) -> tuple[Column, Column]:
    """Start and end of a window in whole epoch seconds."""
    return (
        F.unix_timestamp(window["start"]).alias("window_start"),
        F.unix_timestamp(window["end"]).alias("window_end"),
    )


def window_stem(window_start: Column, window_end: Column) -> Column:
    """File name stem ``<start>_<end>``."""
    return F.concat_ws("_", window_start.cast("string"), window_end.cast("string"))
