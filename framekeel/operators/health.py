"""Health of a print: score per timestamp, running sum, polynomial trend, nested records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..contracts import transform
from .lookups import per_key

# A coefficient below this share of the largest counts as zero.
FLAT = 1e-9
# Roots this close to the real axis, relative to their size, are real: a double root comes in two
# halves that rounding moves apart by the square root of its error.
NEARLY_REAL = 1e-6
DAY = 86_400


@transform(needs="ts bigint, health_weight double, health_score double", gives="ts bigint, health double")
def score_by_ts(rows: DataFrame, *keys: str) -> DataFrame:
    """Best positive plus worst negative health score at each ``ts``; a missing side counts 0.

    Rows of weight 0 and of unknown class take no part, so a ``ts`` with only such rows is left out.
    A score that is not a number counts as missing.
    """
    return rows.where(F.col("health_weight") != 0).groupBy(*keys, "ts").agg(_health().alias("health"))


def second_health() -> Column:
    """The health of the detections of a second, null if none of them has a weight."""
    return F.when(F.count_if(F.col("health_weight") != 0) > 0, _health())


def _health() -> Column:
    score, weight = F.col("health_score"), F.col("health_weight")
    number = ~F.isnan(score)
    best = F.max(F.when(number & (weight > 0), score))
    worst = F.min(F.when(number & (weight < 0), score))
    return F.coalesce(best, F.lit(0.0)) + F.coalesce(worst, F.lit(0.0))


@transform(needs="ts bigint", gives="cumsum double")
def running_sum(scores: DataFrame, *keys: str, value: str = "health", chunk_seconds: int = DAY) -> DataFrame:
    """Add ``cumsum``: the running sum of ``value`` by ``ts`` within ``keys``.

    Works in two levels: sums run inside time chunks, and each chunk starts from the total of the
    chunks before it. A long session is split over tasks; the per-key window sees one row per chunk.
    Rows without a key or ``ts`` have no place in a running sum and are left out. A null value adds
    nothing and gets the sum so far.
    """
    # Asking for keys up front gives both uses of `chunked` the same plan, so its shuffle is shared.
    chunked = scores.withColumn("chunk", F.col("ts") - F.pmod("ts", F.lit(chunk_seconds)))
    for name in (*keys, "chunk"):
        chunked = chunked.where(F.col(name).isNotNull())
    inside = Window.partitionBy(*keys, "chunk").orderBy("ts").rowsBetween(Window.unboundedPreceding, 0)
    before = Window.partitionBy(*keys).orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        chunked.groupBy(*keys, "chunk")
        .agg(F.sum(value).alias("total"))
        .select(*keys, "chunk", F.coalesce(F.sum("total").over(before), F.lit(0.0)).alias("offset"))
    )
    return (
        chunked.withColumn("inside", F.sum(value).over(inside))
        .join(offsets, [*keys, "chunk"])
        .withColumn("cumsum", F.coalesce("inside", F.lit(0.0)) + F.col("offset"))
        .drop("chunk", "inside", "offset")
    )


@transform(gives="n bigint, c0 double, c1 double, root double")
def trend(points: DataFrame, *keys: str, x: str = "ts", y: str = "cumsum") -> DataFrame:
    """Straight line through the points of each key, in one aggregation.

    Coefficients ``c0`` and ``c1`` refer to ``x`` scaled from ``[x_min, x_max]`` to ``[-1, 1]``; the
    root is in units of ``x``. A single point has no coefficients, a flat line no root.
    """
    fitted = points.groupBy(*keys).agg(*(c.alias(n) for n, c in _line_aggregates(x, y).items()))
    return with_line(fitted).select(*keys, "n", "x_min", "x_max", "c0", "c1", "root")


def _line_aggregates(x: str, y: str) -> dict[str, Column]:
    counted = F.when(F.col(y).isNotNull(), F.col(x))
    return {
        "n": F.count(y),
        "x_min": F.min(counted),
        "x_max": F.max(counted),
        "slope": F.regr_slope(y, x),
        "x_mean": F.regr_avgx(y, x),
        "y_mean": F.regr_avgy(y, x),
    }


def with_line(fitted: DataFrame) -> DataFrame:
    """Add ``c0``, ``c1`` and ``root`` to the aggregates of a line."""
    low, high = F.col("x_min"), F.col("x_max")
    return (
        fitted.withColumn("c1", F.col("slope") * (high - low) / 2)
        .withColumn("c0", F.col("y_mean") + F.col("slope") * ((low + high) / 2 - F.col("x_mean")))
        .withColumn(
            "root",
            F.when(
                F.abs("c1") > FLAT * F.greatest(F.abs("c0"), F.abs("c1")),
                low + (1 - F.col("c0") / F.col("c1")) / 2 * (high - low),
            ),
        )
    )


def trend_struct(fitted: DataFrame) -> DataFrame:
    """Pack the columns of :func:`trend` into one ``trend`` record of arrays and degree."""
    line = F.col("c0").isNotNull()
    record = F.struct(
        F.when(line, F.array("c0", "c1")).alias("coef"),
        F.array(F.col("x_min").cast("double"), F.col("x_max").cast("double")).alias("domain"),
        F.array(F.lit(-1.0), F.lit(1.0)).alias("window"),
        F.when(line, F.filter(F.array("root"), lambda r: r.isNotNull())).alias("roots"),
        F.lit(1).alias("degree"),
    )
    return fitted.withColumn("trend", record).drop("c0", "c1", "root", "x_min", "x_max")


def polynomial_trend(points: DataFrame, *keys: str, degree: int, x: str = "ts", y: str = "cumsum") -> DataFrame:
    """Least-squares polynomial of any small degree: ``coef`` and real ``roots`` per key.

    Spark sums the powers of the scaled ``x`` (these add up across tasks, so no key is gathered);
    only the small system of equations of each key is solved in Python, many keys at a time.
    Points without ``x`` or ``y`` take no part. Keys with too few points for the degree have null results.
    """
    points = points.where(F.col(x).isNotNull() & F.col(y).isNotNull())
    # Counting `y` keeps this side's plan equal to the other use of `points`, so Spark shares it.
    domain = per_key(
        points, list(keys), F.count(y).alias("n"), F.min(x).alias("x_min"), F.max(x).alias("x_max")
    )
    low, high = F.col("x_min"), F.col("x_max")
    span = F.when(high > low, high - low)
    scaled = points.join(domain, list(keys)).withColumn("u", -1 + 2 * (F.col(x) - low) / span)
    powers = [F.lit(1.0)]
    for _ in range(2 * degree):
        powers.append(powers[-1] * F.col("u"))
    sums = scaled.groupBy(*keys, "n", "x_min", "x_max").agg(
        F.array(*(F.sum(p) for p in powers)).alias("moments"),
        F.array(*(F.sum(p * F.col(y)) for p in powers[: degree + 1])).alias("products"),
    )

    def solve(batches):
        import numpy as np
        import pyarrow as pa

        size = degree + 1
        shift = np.arange(size)[:, None] + np.arange(size)

        def numbers(batch, name, width=None):
            column = batch.column(name)
            if width:
                return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
            return column.to_numpy(zero_copy_only=False).astype(float)

        def lists(rows, given):
            """Rows of a matrix as lists without their NaN values; null where not ``given``."""
            filled = ~np.isnan(rows)
            ends = np.concatenate([[0], np.cumsum(filled.sum(axis=1))]).astype(np.int32)
            return pa.ListArray.from_arrays(pa.array(ends), pa.array(rows[filled]), mask=pa.array(~given))

        for batch in batches:
            given = numbers(batch, "n") > degree
            moments = numbers(batch, "moments", 2 * degree + 1)[given]
            products = numbers(batch, "products", size)[given]
            # Pseudo-inverses also serve systems without a unique solution.
            inverse = np.linalg.pinv(moments[:, shift], hermitian=True)
            coefs = np.full((len(given), size), np.nan)
            coefs[given] = (inverse @ products[:, :, None])[:, :, 0]

            # Roots are the eigenvalues of the companion matrix, for the degree the fit really has.
            roots = np.full((len(given), degree), np.nan)
            tall = np.abs(coefs) > FLAT * np.nan_to_num(np.abs(coefs)).max(axis=1, keepdims=True)
            order = np.where(tall.any(axis=1), degree - np.argmax(tall[:, ::-1], axis=1), 0)
            for m in range(1, size):
                same = np.flatnonzero(order == m)
                companion = np.zeros((len(same), m, m))
                companion[:, np.arange(1, m), np.arange(m - 1)] = 1.0
                companion[:, :, -1] -= coefs[same, :m] / coefs[same, m : m + 1]
                found = np.linalg.eigvals(companion)
                real = np.abs(found.imag) <= NEARLY_REAL * (1 + np.abs(found))
                roots[same, :m] = np.where(real, found.real, np.nan)
            low, high = numbers(batch, "x_min")[:, None], numbers(batch, "x_max")[:, None]
            roots = np.sort(low + (roots + 1) / 2 * (high - low), axis=1)

            kept = [c for c in batch.schema.names if c not in ("moments", "products")]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in kept), lists(coefs, given), lists(roots, given)],
                names=[*kept, "coef", "roots"],
            )

    schema = sums.drop("moments", "products").schema
    doubles = T.ArrayType(T.DoubleType())
    schema = schema.add("coef", doubles).add("roots", doubles)
    return sums.mapInArrow(solve, schema)


def nested_records(
    rows: DataFrame, key: str, period_seconds: int, order_id: list[str], *carry: str
) -> DataFrame:
    """One record per key, window and ``ts``: its detections as arrays, its health and the running sum.

    ``rows`` are detections with ``window_start``, ``ts`` and the health columns; the grouping is the same
    whatever their number, and a record holds what one second has. ``carry`` are further columns of
    which a record has the first. Each point of the running sum, which starts anew in every window, is
    in one record; the trend of the window's points is in the window's last one.
    """
    group = [key, "window_start"]
    for name in (*group, "ts"):
        rows = rows.where(F.col(name).isNotNull())
    detection = F.struct(*order_id, "health_score", "health_weight", "detection_class", "detection_score")
    first = F.min(F.struct(*order_id, *(c for c in carry if c not in order_id)))
    records = rows.groupBy(*group, "ts").agg(
        F.sort_array(F.collect_list(detection)).alias("d"),
        second_health().alias("health"),
        first.alias("first"),
    )
    whole = Window.partitionBy(*group)
    upto = whole.orderBy("ts").rowsBetween(Window.unboundedPreceding, 0)
    records = records.withColumn("cumsum", F.when(F.col("health").isNotNull(), F.sum("health").over(upto)))
    lines = with_line(
        records.select(
            "*",
            (F.col("ts") == F.max("ts").over(whole)).alias("closing"),
            *(c.over(whole).alias(n) for n, c in _line_aggregates("ts", "cumsum").items()),
        )
    )
    poly = F.when(F.col("closing") & (F.col("n") > 0), F.col("trend"))
    return trend_struct(lines).select(
        key,
        "window_start",
        (F.col("window_start") + period_seconds).alias("window_end"),
        "ts",
        *(F.col(f"first.{c}").alias(c) for c in carry),
        *(
            F.col(f"d.{c}").alias(c)
            for c in ("health_score", "health_weight", "detection_class", "detection_score")
        ),
        "health",
        "cumsum",
        poly["coef"].alias("poly_coef"),
        poly["domain"].alias("poly_domain"),
        poly["roots"].alias("poly_roots"),
        poly["degree"].alias("poly_degree"),
    )
