"""Object detection on frames with a model supplied by the caller."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import MODEL_OUTPUT
from .nested import postprocess


def score_frames(
    frames: DataFrame,
    load_model: Callable[[], Callable],
    image: str = "image_data",
    *,
    batch_size: int = 64,
    cut_to_count: bool = False,
    strict: bool = False,
    keep_image: bool = False,
    version: str | None = None,
) -> DataFrame:
    """Add ``annotations_all``, ``predict_ms`` and ``predict_images``; the image goes unless ``keep_image``.

    ``load_model`` returns a function from a list of images to a list of ``(boxes, classes, scores, count)``. It is
    called once per task, or, if the model has a ``version``, about once per Python worker, which keeps the model for
    later tasks and micro-batches; another version is another model. A result that is no such tuple, or holds what is
    no number, becomes a frame without these detections and numbers; it does not stop the job. Images go to the model
    in batches; turning its output into annotations happens in Spark expressions. A frame whose image is null keeps null annotations.
    The first frame of a batch has the duration of the model's call and its number of images, the
    others have nulls, so each call counts once.
    """
    kept = [f for f in frames.schema.fields if keep_image or f.name != image]
    schema = T.StructType(
        [
            *kept,
            T.StructField("raw", MODEL_OUTPUT),
            T.StructField("predict_ms", T.LongType()),
            T.StructField("predict_images", T.LongType()),
        ]
    )
    carried = [f.name for f in kept]

    def predict(batches):
        import time

        import numpy as np
        import pyarrow as pa

        if version is None:
            model = load_model()
        else:
            # Workers that keep no model need not have the package.
            from framekeel.operators.models import held

            model = held(version, load_model)
        raw_type = pa.struct(
            [
                ("boxes", pa.list_(pa.list_(pa.float64()))),
                ("classes", pa.list_(pa.float64())),
                ("scores", pa.list_(pa.float64())),
                ("count", pa.float64()),
            ]
        )

        def lists(parts, missing):
            """One list of numbers per frame; null where the frame has no image."""
            sizes = [0 if p is None else len(p) for p in parts]
            whole = np.concatenate([np.empty(0), *(np.asarray(p, dtype=np.float64).ravel() for p in parts if p is not None)])
            ends = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
            return whole, ends, pa.array(missing)

        def number(value):
            try:
                return float(value)
            except (TypeError, ValueError, OverflowError):
                return float("nan")

        def listed(values):
            return list(values) if np.iterable(values) and not isinstance(values, (str, bytes, dict)) else []

        def repaired(result):
            """A result of any kind as lists of numbers, NaN for what is none, and boxes of four corners."""
            boxes, classes, scores, count = result if isinstance(result, (tuple, list)) and len(result) == 4 else ((), (), (), 0)
            corners = [[number(c) for c in [*listed(b), *[None] * 4][:4]] for b in listed(boxes)]
            return corners, [number(c) for c in listed(classes)], [number(s) for s in listed(scores)], number(count)

        def sound(result):
            try:
                packed([result])
                return result
            except (TypeError, ValueError, IndexError, KeyError, OverflowError):
                return repaired(result)

        def output(results):
            try:
                return packed(results)
            except (TypeError, ValueError, IndexError, KeyError, OverflowError):
                # Only those results are changed that do not fit by themselves.
                return packed([None if r is None else sound(r) for r in results])

        def packed(results):
            missing = [r is None for r in results]

            def part(k):
                return [None if r is None else r[k] for r in results]

            flat, ends, none = lists(part(0), missing)
            filled = [p for p in part(0) if p is not None and len(p)]
            corners = np.repeat(np.array([np.shape(p)[1] for p in filled], dtype=np.int64), [len(p) for p in filled])
            inner = np.concatenate([[0], np.cumsum(corners)]).astype(np.int32)
            if inner[-1] != len(flat):
                raise ValueError("boxes are no lists of numbers")
            boxes = pa.ListArray.from_arrays(pa.array(inner), pa.array(flat))
            columns = [pa.ListArray.from_arrays(pa.array(ends), boxes, mask=none)]
            for k in (1, 2):
                flat, ends, none = lists(part(k), missing)
                if ends[-1] != len(flat):
                    raise ValueError("classes or scores are no numbers")
                columns.append(pa.ListArray.from_arrays(pa.array(ends), pa.array(flat), mask=none))
            columns.append(pa.array([None if c is None else float(c) for c in part(3)], pa.float64()))
            return pa.StructArray.from_arrays(columns, fields=list(raw_type), mask=none)

        for batch in batches:
            # The model gets its images in batches of its own; rows come out as they came in.
            every = batch.column(image).to_pylist()
            found, spent, seen = [], [None] * len(every), [None] * len(every)
            for at in range(0, len(every), batch_size):
                part = every[at : at + batch_size]
                images = [i for i in part if i is not None]
                start = time.monotonic()
                results = iter(model(images) if images else [])
                elapsed = int((time.monotonic() - start) * 1000)
                first = next((at + k for k, i in enumerate(part) if i is not None), None)
                if first is not None:
                    spent[first], seen[first] = elapsed, len(images)
                # A model that gives too few results gives none for the rest.
                found.extend(None if i is None else next(results, ()) for i in part)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(f) for f in carried), output(found), pa.array(spent, pa.int64()), pa.array(seen, pa.int64())],
                names=[*carried, "raw", "predict_ms", "predict_images"],
            )

    scored = frames.mapInArrow(predict, schema)
    raw = F.col("raw")
    found = postprocess(
        raw["boxes"],
        raw["classes"],
        raw["scores"],
        raw["count"],
        cut_to_count=cut_to_count,
        strict=strict,
    )
    return scored.withColumn("annotations_all", F.when(raw.isNotNull(), found)).drop("raw")
