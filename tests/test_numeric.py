"""Histogram, PCA and regression against numpy."""

import numpy as np
import pytest

from tripflow.functions import square_udf
from tripflow.medallion.learning import fit_fare_regression, regression_terms, run_pca
from tripflow.operators import column_histograms, numeric_columns

RNG = np.random.default_rng(3)


@pytest.fixture(scope="module")
def frame(spark):
    x = RNG.integers(0, 101, 500) / 4.0
    y = 2 * x + RNG.normal(size=500)
    z = RNG.normal(size=500)
    rows = [(float(a), float(b), float(c), "t", 5) for a, b, c in zip(x, y, z)]
    rows += [(None, float("nan"), None, None, 5)]
    return spark.createDataFrame(rows, "x double, y double, z double, s string, c int").cache()


def column(frame, name):
    values = np.array([r[0] for r in frame.select(name).collect() if r[0] is not None], dtype=float)
    return values[np.isfinite(values)]


def test_numeric_columns(frame):
    assert numeric_columns(frame) == ["x", "y", "z", "c"]


@pytest.mark.parametrize("name", ["x", "y", "z", "c"])
def test_histogram_like_numpy(frame, name):
    counts, edges = np.histogram(column(frame, name), bins=50)
    got = column_histograms(frame).filter(f"column = '{name}'").orderBy("bin").collect()
    assert [r.n for r in got] == counts.tolist()
    assert np.allclose([r.low for r in got] + [got[-1].high], edges)


def test_histogram_without_values(spark):
    empty = spark.createDataFrame([(None,)], "x double")
    assert column_histograms(empty).count() == 0
    assert column_histograms(spark.createDataFrame([(1.0,)], "x double"), bins=4).filter("n = 1").count() == 1


def test_histogram_of_a_sample(frame):
    got = column_histograms(frame, ["x"], bins=10, fraction=0.5, seed=1).agg({"n": "sum"}).first()[0]
    assert 150 < got < 350


def test_pca_like_numpy(frame):
    scores, explained = run_pca(frame.drop("c").na.drop(), 1.0, 3)
    data = np.column_stack([column(frame, c) for c in "xyz"])
    values = np.sort(np.linalg.eigvalsh(np.corrcoef(data.T)))[::-1]
    assert np.allclose([r.explained_variance for r in explained.orderBy("component").collect()], values / values.sum())
    assert scores.count() == 500
    assert len(scores.first().scores) == 3


def test_components_like_numpy(spark):
    from tripflow.medallion.learning import fit_components

    x = RNG.normal(size=(400, 4)) @ RNG.normal(size=(4, 4)) + 1e6
    rows = [(*map(float, r), 3.0, "t") for r in x] + [(None, 1.0, 1.0, 1.0, 3.0, "t"), (float("nan"), 1.0, 1.0, 1.0, 3.0, "t")]
    df = spark.createDataFrame(rows, "a double, `b.c` double, c double, d double, same double, name string").repartition(5)
    model = fit_components(df, ["a", "b.c", "c", "d", "same"])
    values, vectors = np.linalg.eigh(np.corrcoef(x.T))
    assert np.allclose(model.variances, [*values[::-1], 0.0]) and len(model.loadings) == 5
    assert np.allclose(np.abs(np.array(model.loadings)[:4, :4]), np.abs(vectors[:, ::-1].T), atol=1e-6)
    scored = [r.scores for r in model.scores(df).collect()]
    assert sum(s is None for s in scored) == 2
    scores = np.array([s for s in scored if s is not None])
    assert np.allclose(np.cov(scores.T), np.diag([*values[::-1], 0.0]), atol=1e-6)
    with pytest.raises(ValueError, match="components"):
        fit_components(df, ["a"], 2)


def test_regression_like_numpy(spark):
    d, m = RNG.uniform(0, 20, 200), RNG.uniform(1, 60, 200)
    total = 3 + 2.5 * d + 0.5 * m + RNG.normal(size=200)
    rows = [tuple(map(float, r)) for r in zip(d, m, total)]
    trips = spark.createDataFrame(rows, "trip_distance double, trip_duration_minutes double, total_amount double")
    model, predictions = fit_fare_regression(trips)
    design = np.column_stack([np.ones(200), d, m])
    weights = np.linalg.lstsq(design, total, rcond=None)[0]
    assert np.allclose([r.weight for r in regression_terms(trips, model).collect()], weights)
    assert np.allclose([r.prediction for r in predictions.collect()], design @ weights)


def test_square_udf(spark):
    df = spark.createDataFrame([(1.5,), (None,), (-2.0,)], "x double")
    assert [r[0] for r in df.select(square_udf()("x")).collect()] == [2.25, None, 4.0]


def test_fingerprint_works_each_row_out_once(spark):
    from tripflow.operators.fingerprint import fingerprint

    df = spark.range(1000).selectExpr("id", "id / 7 AS x", "nullif(id, 3) AS y")
    plan = fingerprint(df)._jdf.queryExecution().executedPlan().toString()
    sums = [line for line in plan.splitlines() if "sum(" in line]
    assert sums and not any("md5" in line or "concat_ws" in line for line in sums)
    rows = fingerprint(df.union(df)).first(), fingerprint(df).first()
    assert int(rows[0].fingerprint) == 2 * int(rows[1].fingerprint) > 2**49 and rows[0].n == 2000
    assert tuple(fingerprint(df.limit(0)).first()) == (0, "0")
