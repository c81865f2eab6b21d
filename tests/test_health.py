import numpy as np
import pytest
from pyspark.sql import functions as F

from framekeel.operators import health

ROWS = "session string, ts long, detection_class int, detection_score double, health_weight double, frame_id long"


def rows(spark, data):
    df = spark.createDataFrame(data, ROWS)
    return df.withColumn("health_score", F.col("health_weight") * F.col("detection_score"))


def test_score_is_best_plus_worst(spark):
    df = rows(
        spark,
        [
            ("a", 1, 4, 0.9, 1.0, 1),
            ("a", 1, 5, 0.4, 1.0, 1),
            ("a", 1, 3, 0.8, -0.5, 1),
            ("a", 1, 2, 0.2, -0.5, 1),
            ("a", 2, 4, 0.3, 1.0, 2),
            ("a", 3, 3, 0.6, -0.5, 3),
            ("a", 4, 1, 0.9, 0.0, 4),
            ("a", 5, 6, 0.9, None, 5),
        ],
    )
    got = {r["ts"]: round(r["health"], 9) for r in health.score_by_ts(df, "session").collect()}
    assert got == {1: 0.5, 2: 0.3, 3: -0.3}


def series(spark, n=50, seed=1):
    rng = np.random.default_rng(seed)
    out = []
    for key in "abc":
        ts = np.sort(rng.choice(100_000, n, replace=False)) + 1_600_000_000
        out += [(key, int(t), float(v)) for t, v in zip(ts, rng.normal(size=n))]
    return out


def by_key(data):
    return {k: np.array([(t, v) for s, t, v in data if s == k]) for k in {d[0] for d in data}}


@pytest.mark.parametrize("chunk", [1, 5_000, 86_400, 10**9])
def test_running_sum_does_not_depend_on_chunks(spark, chunk):
    data = series(spark)
    df = spark.createDataFrame(data, "session string, ts long, health double")
    got = health.running_sum(df, "session", chunk_seconds=chunk).orderBy("session", "ts").collect()
    for key, points in by_key(data).items():
        np.testing.assert_allclose([r["cumsum"] for r in got if r["session"] == key], np.cumsum(points[:, 1]), atol=1e-9)


def test_line_matches_numpy(spark):
    data = series(spark)
    df = spark.createDataFrame(data, "session string, ts long, cumsum double")
    got = {r["session"]: r for r in health.trend(df, "session").collect()}
    records = {r["session"]: r["trend"] for r in health.trend_struct(health.trend(df, "session")).collect()}
    for key, points in by_key(data).items():
        fit = np.polynomial.Polynomial.fit(points[:, 0], points[:, 1], 1)
        np.testing.assert_allclose([got[key]["c0"], got[key]["c1"]], fit.coef, atol=1e-8)
        np.testing.assert_allclose(got[key]["root"], fit.roots()[0], rtol=1e-9)
        assert (got[key]["x_min"], got[key]["x_max"]) == tuple(fit.domain)
        np.testing.assert_allclose(records[key]["coef"], fit.coef, atol=1e-8)
        assert records[key]["window"] == [-1, 1] and records[key]["degree"] == 1


@pytest.mark.parametrize("degree", [1, 2, 3, 4])
def test_polynomial_matches_numpy(spark, degree):
    data = series(spark, seed=degree)
    df = spark.createDataFrame(data, "session string, ts long, cumsum double")
    got = {r["session"]: r for r in health.polynomial_trend(df, "session", degree=degree).collect()}
    for key, points in by_key(data).items():
        fit = np.polynomial.Polynomial.fit(points[:, 0], points[:, 1], degree)
        np.testing.assert_allclose(got[key]["coef"], fit.coef, atol=1e-7)
        roots = fit.roots()
        real = np.sort(roots[np.abs(np.imag(roots)) < 1e-9].real)
        np.testing.assert_allclose(got[key]["roots"], real, rtol=1e-7)


def test_short_and_flat_series(spark):
    data = [("one", 5, 1.0)] + [("flat", t, 2.0) for t in range(4)]
    df = spark.createDataFrame(data, "session string, ts long, cumsum double")
    got = {r["session"]: r for r in health.trend(df, "session").collect()}
    assert (got["one"]["c0"], got["one"]["c1"], got["one"]["root"]) == (None, None, None)
    assert got["flat"]["c0"] == pytest.approx(2.0) and got["flat"]["root"] is None
    records = {r["session"]: r["trend"] for r in health.trend_struct(health.trend(df, "session")).collect()}
    assert records["one"]["coef"] is None and records["flat"]["roots"] == []
    poly = {r["session"]: r for r in health.polynomial_trend(df, "session", degree=2).collect()}
    assert poly["one"]["coef"] is None and poly["flat"]["coef"] == pytest.approx([2, 0, 0])
    assert len(poly["flat"]["roots"]) == 0


def test_nested_records_hold_every_detection_once(spark):
    rng = np.random.default_rng(9)
    weights = {0: 0.0, 3: -0.5, 4: 1.0}
    data = []
    for i in range(300):
        label = int(rng.choice(list(weights)))
        # A tenth of the rows share one timestamp.
        ts = 30 if i % 10 == 0 else int(rng.integers(0, 180))
        data.append(("a" if i % 3 else "b", ts, label, float(rng.integers(0, 100)) / 100, weights[label], i))
    df = rows(spark, data).withColumn("window_start", F.col("ts") - F.col("ts") % 60)
    got = health.nested_records(df, "session", 60, ["frame_id"], "frame_id").orderBy("session", "ts").collect()
    assert len(got) == len({(d[0], d[1]) for d in data})
    found = sorted((r["session"], r["ts"], s) for r in got for s in r["detection_score"])
    assert found == sorted((d[0], d[1], d[3]) for d in data)
    assert all(len(r["detection_class"]) == len(r["health_weight"]) == len(r["health_score"]) for r in got)
    assert all(r["frame_id"] == min(d[5] for d in data if d[:2] == (r["session"], r["ts"])) for r in got)
    scores = health.score_by_ts(df, "session", "window_start").toPandas().sort_values("ts")
    for (session, start), part in scores.groupby(["session", "window_start"]):
        records = [r for r in got if (r["session"], r["window_start"]) == (session, start)]
        sums = [round(r["cumsum"], 9) for r in records if r["cumsum"] is not None]
        assert sums == part["health"].cumsum().round(9).tolist()
        assert all(r["window_end"] == start + 60 for r in records)
        assert [r["poly_degree"] for r in records] == [None] * (len(records) - 1) + [1]
        fit = np.polynomial.Polynomial.fit(part["ts"], part["health"].cumsum(), 1)
        np.testing.assert_allclose(records[-1]["poly_coef"], fit.coef, atol=1e-9)


def test_polynomials_with_nulls_touching_and_small_units(spark):
    x = np.arange(10)
    data = [("touch", int(t), float((t - 4) ** 2)) for t in range(9)]
    data += [("nulls", int(t), float(t * t)) for t in x] + [("nulls", int(t) + 50, None) for t in x]
    data += [("small", int(t), float(1e-10 * (t - 2.5) * (t - 7))) for t in x]
    points = spark.createDataFrame(data, "session string, ts long, cumsum double")
    got = {r["session"]: r for r in health.polynomial_trend(points, "session", degree=2).collect()}
    assert got["touch"]["roots"] == pytest.approx([4, 4], abs=1e-5)
    assert got["nulls"]["n"] == 10 and got["nulls"]["x_max"] == 9
    assert got["nulls"]["coef"] == pytest.approx([20.25, 40.5, 20.25])
    assert got["nulls"]["roots"] == pytest.approx([0, 0], abs=1e-4)
    assert got["small"]["roots"] == pytest.approx([2.5, 7])
    lines = spark.createDataFrame([("s", t, 1e-12 * (t - 3)) for t in range(9)], "session string, ts long, cumsum double")
    assert health.trend(lines, "session").first()["root"] == pytest.approx(3)


@pytest.mark.parametrize("chunk", [1, 3, 7, 1000])
def test_running_sum_carries_on_over_nulls(spark, chunk):
    values = [None, 1.0, 2.0, None, None, 4.0, None, 3.0, None, 0.5]
    scores = spark.createDataFrame([("s", t, v) for t, v in enumerate(values)], "session string, ts long, health double")
    got = [r["cumsum"] for r in health.running_sum(scores, "session", chunk_seconds=chunk).orderBy("ts").collect()]
    assert got == [0, 1, 3, 3, 3, 7, 7, 10, 10, 10.5]


def test_scores_that_are_no_numbers_count_as_missing(spark):
    data = [("s", 1, 4, float("nan"), 1.0, 1), ("s", 1, 4, 0.5, 1.0, 2), ("s", 2, 3, float("nan"), -0.5, 3)]
    got = {r["ts"]: r["health"] for r in health.score_by_ts(rows(spark, data), "session").collect()}
    assert got == {1: 0.5, 2: 0.0}
