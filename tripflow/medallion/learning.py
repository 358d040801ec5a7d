"""Principal components and a linear model over clean trips."""

from __future__ import annotations

import functools
import itertools
import operator
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression, LinearRegressionModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripflow.operators.histogram import numeric_columns
from tripflow.operators.sampling import sample_by_hash


@dataclass(frozen=True)
class Components:
    """Principal components of standardised columns: means, deviations, variances along the components, and loadings by row."""

    columns: tuple[str, ...]
    means: tuple[float, ...]
    deviations: tuple[float, ...]
    variances: tuple[float, ...]
    loadings: tuple[tuple[float, ...], ...]

    def scores(self, df: DataFrame, out: str = "scores") -> DataFrame:
        """Adds the scores of each row as an array; null for a row with a missing value. One projection."""
        standard = [
            (F.col(f"`{c}`").cast("double") - m) / s if s else F.col(f"`{c}`").cast("double") * 0.0
            for c, m, s in zip(self.columns, self.means, self.deviations)
        ]
        sums = [functools.reduce(operator.add, (z * w for z, w in zip(standard, row))) for row in self.loadings]
        return df.withColumn(out, F.when(_complete(self.columns), F.array(*sums)))


def _complete(columns: Sequence[str]) -> Column:
    known = (F.col(f"`{c}`").isNotNull() & ~F.isnan(F.col(f"`{c}`").cast("double")) for c in columns)
    return functools.reduce(operator.and_, known)


def fit_components(df: DataFrame, columns: Sequence[str], k: int | None = None) -> Components:
    """Components from one native aggregate: moments per column and a covariance per pair.

    The covariances are aggregated where the rows are, each by an update that loses no digits to large
    means, and one row of columns squared numbers reaches the driver. Rows with a missing
    value are left out; a constant column has correlation 0. The largest loading of a component (the
    first of equal ones) is positive.
    """
    columns = list(columns)
    k = len(columns) if k is None else k
    if not 0 < k <= len(columns):
        raise ValueError(f"{len(columns)} columns have no {k} components")
    values = [F.col(f"`{c}`").cast("double") for c in columns]
    pairs = list(itertools.combinations(range(len(columns)), 2))
    row = df.filter(_complete(columns)).agg(
        *(F.avg(v).alias(f"m{i}") for i, v in enumerate(values)),
        *(F.stddev_samp(v).alias(f"s{i}") for i, v in enumerate(values)),
        *(F.covar_samp(values[i], values[j]).alias(f"c{i}_{j}") for i, j in pairs),
    ).first()
    spread = [float(row[f"s{i}"] or 0.0) for i in range(len(columns))]
    matrix = np.diag([float(s > 0) for s in spread])
    for i, j in pairs:
        if spread[i] and spread[j]:
            matrix[i, j] = matrix[j, i] = row[f"c{i}_{j}"] / (spread[i] * spread[j])
    found, vectors = np.linalg.eigh(matrix)
    order = np.argsort(-found, kind="stable")[:k]
    loadings = []
    for v in vectors[:, order].T:
        lead = int(np.flatnonzero(np.abs(v) >= np.abs(v).max() - 1e-9)[0])
        loadings.append(tuple(map(float, v if v[lead] > 0 else -v)))
    means = tuple(float(row[f"m{i}"] or 0.0) for i in range(len(columns)))
    return Components(tuple(columns), means, tuple(spread), tuple(map(float, found[order])), tuple(loadings))


def run_pca(
    df: DataFrame, sample_fraction: float = 0.2, k: int = 5, seed: int = 42, columns: Sequence[str] | None = None
) -> tuple[DataFrame, DataFrame]:
    """(scores, explained variance) of the standardised numeric columns.

    Rows with a missing value are left out. The sample is drawn by a hash of the measured values, so
    that it doesn't depend on the layout of the table.
    """
    columns = numeric_columns(df) if columns is None else list(columns)
    measured = sample_by_hash(df.select(*[F.col(f"`{c}`") for c in columns]), sample_fraction, seed)
    model = fit_components(measured, columns, k)
    whole = sum(s > 0 for s in model.deviations) or 1
    rows = [(i, v / whole, v) for i, v in enumerate(model.variances, start=1)]
    explained = df.sparkSession.createDataFrame(rows, "component int, explained_variance double, variance double")
    return model.scores(measured).filter("scores IS NOT NULL").select("scores"), explained.drop("variance")


FARE_FEATURES = ("trip_distance", "trip_duration_minutes")
FARE_LABEL = "total_amount"


def fit_fare_regression(
    trips: DataFrame, features: Sequence[str] = FARE_FEATURES, label: str = FARE_LABEL
) -> tuple[LinearRegressionModel, DataFrame]:
    """A linear model of the trip total, and its predictions on the training rows."""
    rows = VectorAssembler(inputCols=list(features), outputCol="features").transform(trips)
    model = LinearRegression(featuresCol="features", labelCol=label).fit(rows)
    return model, model.transform(rows).select(*features, label, "prediction")


def regression_terms(trips: DataFrame, model: LinearRegressionModel, features: Sequence[str] = FARE_FEATURES) -> DataFrame:
    terms = [("intercept", float(model.intercept)), *zip(features, map(float, model.coefficients))]
    return trips.sparkSession.createDataFrame(terms, "term string, weight double")
