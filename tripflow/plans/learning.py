"""Spark ML jobs."""

from __future__ import annotations

from pyspark.sql import functions as F

from tripflow.medallion.learning import fit_components, fit_fare_regression, regression_terms, run_pca
from tripflow.medallion import silver
from tripflow.plans import trips
from tripflow.plans.base import query
from tripflow.plans.medallion import yellow_trips
from tripflow.session import scratch_path
from tripflow.sources import save

# The coordinates are missing in the modern layout, so no row would be complete with them.
PCA_COLUMNS = [
    "passenger_count", "trip_distance", "fare_amount", "tip_amount", "tolls_amount", "total_amount", "mta_tax",
    "surcharge", "trip_duration_minutes",
]


def clean_trips(spark, sf, trips_of=yellow_trips):
    """The clean table as written once: iterative fits read it several times."""
    path = scratch_path(spark, "yellow_taxi")
    save(trips_of(spark, sf), path)
    return spark.read.parquet(path)


def all_yellow_trips(spark, sf):
    """The trips of all families."""
    return silver.yellow(trips.raw_families(spark, sf))


@query("pca_explained")
def pca_explained(spark, sf):
    """Explained variance of five components over a seeded fifth of the trips."""
    return run_pca(clean_trips(spark, sf), columns=PCA_COLUMNS)[1]


# Two standardised columns with correlation r have components of (1 + |r|)/2 and (1 - |r|)/2.
@query(
    "pca_two_columns",
    f"""WITH c AS (SELECT abs(corr(trip_distance, fare_amount)) AS r FROM ({trips.YELLOW_MODERN_SQL}))
        SELECT CAST(1 AS INTEGER) AS component, round((1 + r) / 2, 8) AS explained_variance FROM c
        UNION ALL SELECT 2, round((1 - r) / 2, 8) FROM c""",
)
def pca_two_columns(spark, sf):
    explained = run_pca(clean_trips(spark, sf), 1.0, 2, columns=["trip_distance", "fare_amount"])[1]
    return explained.withColumn("explained_variance", F.round("explained_variance", 8))


# The variances of all components add up to the number of columns that vary, and their squares to those of all correlations.
_VARIES_SQL = " + ".join(f"CAST(stddev_samp({c}) > 0 AS INTEGER)" for c in PCA_COLUMNS)
_PAIRS_SQL = " + ".join(
    f"CASE WHEN stddev_samp({a}) > 0 AND stddev_samp({b}) > 0 THEN 2 * corr({a}, {b}) ** 2 ELSE 0 END"
    for i, a in enumerate(PCA_COLUMNS) for b in PCA_COLUMNS[i + 1 :]
)
_KNOWN_SQL = " AND ".join(f"{c} IS NOT NULL" for c in PCA_COLUMNS)


@query(
    "pca_all_components",
    f"""SELECT CAST({len(PCA_COLUMNS)} AS BIGINT) AS components, round(CAST({_VARIES_SQL} AS DOUBLE), 6) AS trace,
               round({_VARIES_SQL} + {_PAIRS_SQL}, 6) AS squares
        FROM ({trips.YELLOW_FAMILIES_SQL}) WHERE {_KNOWN_SQL}""",
)
def pca_all_components(spark, sf):
    """All components of the whole table, by what their variances and squared variances add up to."""
    model = fit_components(clean_trips(spark, sf, all_yellow_trips), PCA_COLUMNS)
    rows = spark.createDataFrame([(v,) for v in model.variances], "v double")
    return rows.agg(
        F.count("*").alias("components"), F.round(F.sum("v"), 6).alias("trace"), F.round(F.sum(F.col("v") * F.col("v")), 6).alias("squares")
    )


_Z_SQL = [f"({c} - avg({c}) OVER ()) / stddev_samp({c}) OVER ()" for c in ("trip_distance", "fare_amount")]


@query(
    "pca_scores",
    f"""WITH z AS (
            SELECT trip_distance, fare_amount, {_Z_SQL[0]} AS z1, {_Z_SQL[1]} AS z2,
                   sign(corr(trip_distance, fare_amount) OVER ()) AS s
            FROM ({trips.YELLOW_MODERN_SQL}))
        SELECT trip_distance, fare_amount, round((z1 + s * z2) / sqrt(2), 6) + 0 AS first, round((z1 - s * z2) / sqrt(2), 6) + 0 AS second
        FROM z""",
)
def pca_scores(spark, sf):
    """Every trip's scores on the two components of two standardised columns."""
    rows = clean_trips(spark, sf)
    model = fit_components(rows, ["trip_distance", "fare_amount"])
    scored = model.scores(rows.select("trip_distance", "fare_amount"))
    at = lambda i: (F.round(F.get("scores", F.lit(i)), 6) + 0.0)
    return scored.select("trip_distance", "fare_amount", at(0).alias("first"), at(1).alias("second"))


# Least squares with two features, from the covariances of the columns.
_TERMS_SQL = f"""
    WITH m AS (
        SELECT avg(trip_distance) AS m1, avg(trip_duration_minutes) AS m2, avg(total_amount) AS my,
               var_pop(trip_distance) AS v1, var_pop(trip_duration_minutes) AS v2,
               covar_pop(trip_distance, trip_duration_minutes) AS c12,
               covar_pop(trip_distance, total_amount) AS c1y, covar_pop(trip_duration_minutes, total_amount) AS c2y
        FROM ({trips.YELLOW_MODERN_SQL})),
    b AS (SELECT *, (c1y * v2 - c2y * c12) / (v1 * v2 - c12 * c12) AS b1,
                 (c2y * v1 - c1y * c12) / (v1 * v2 - c12 * c12) AS b2 FROM m),
    terms AS (SELECT b1, b2, my - b1 * m1 - b2 * m2 AS b0 FROM b)"""


@query(
    "fare_regression",
    f"""{_TERMS_SQL} SELECT 'intercept' AS term, round(b0, 6) AS weight FROM terms
        UNION ALL SELECT 'trip_distance', round(b1, 6) FROM terms
        UNION ALL SELECT 'trip_duration_minutes', round(b2, 6) FROM terms""",
)
def fare_regression(spark, sf):
    rows = clean_trips(spark, sf)
    model, _ = fit_fare_regression(rows)
    return regression_terms(rows, model).withColumn("weight", F.round("weight", 6))


@query(
    "fare_predictions",
    f"""{_TERMS_SQL} SELECT trip_distance, trip_duration_minutes, total_amount,
               round(b0 + b1 * trip_distance + b2 * trip_duration_minutes, 3) AS prediction
        FROM ({trips.YELLOW_MODERN_SQL}), terms""",
)
def fare_predictions(spark, sf):
    _, predictions = fit_fare_regression(clean_trips(spark, sf))
    return predictions.withColumn("prediction", F.round("prediction", 3))
