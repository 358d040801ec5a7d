"""Equal-width histograms of all numeric columns in two passes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Type names of numbers; decimals carry their digits behind the name. Booleans, dates, times and text aren't measured.
MEASURED = ("tinyint", "smallint", "int", "bigint", "float", "double", "decimal")


def numeric_columns(df: DataFrame) -> list[str]:
    """The columns that hold numbers, in order, by the names of their types."""
    return [name for name, kind in df.dtypes if kind.partition("(")[0] in MEASURED]


def column_histograms(
    df: DataFrame,
    columns: Sequence[str] | None = None,
    bins: int = 50,
    fraction: float | None = None,
    seed: int | None = None,
) -> DataFrame:
    """(column, bin, low, high, n) for `bins` equal bins between each column's extremes.

    The last bin includes the maximum; a constant column is centred in a range
    of width 1; missing values, NaN and infinities are not counted. The extremes
    are one row of the driver's size, the counts are aggregated before the shuffle.
    """
    columns = numeric_columns(df) if columns is None else list(columns)
    source = df.sample(fraction=fraction, seed=seed) if fraction is not None else df
    finite = source.select(
        *(
            F.when(~F.isnan(v) & (F.abs(v) != F.lit(float("inf"))), v).alias(c)
            for c in columns
            for v in [F.col(c).cast("double")]
        )
    )
    extremes = finite.agg(
        *(F.min(c).alias(f"lo_{i}") for i, c in enumerate(columns)),
        *(F.max(c).alias(f"hi_{i}") for i, c in enumerate(columns)),
    ).first()

    bounds = {}
    for i, c in enumerate(columns):
        low, high = extremes[f"lo_{i}"], extremes[f"hi_{i}"]
        if low is not None:
            bounds[c] = (low - 0.5, high + 0.5) if low == high else (low, high)
    spark = df.sparkSession
    ddl = "column string, low double, high double"
    limits = spark.createDataFrame([(c, low, high) for c, (low, high) in bounds.items()], ddl)

    def edge(i: Column, low: Column, high: Column) -> Column:
        return F.when(i == bins, high).otherwise(low + i * ((high - low) / bins))

    slots = limits.select("column", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"), "low", "high")
    ends = F.col("low"), F.col("high")
    all_bins = slots.select(
        "column", "bin", edge(F.col("bin"), *ends).alias("low"), edge(F.col("bin") + 1, *ends).alias("high")
    )
    if not bounds:
        return all_bins.withColumn("n", F.lit(0).cast("bigint"))

    # Each cell carries its column's extremes, so one short expression bins them all.
    cells = F.array(
        *(
            F.struct(F.lit(c).alias("column"), F.col(c).alias("v"), F.lit(low).alias("low"), F.lit(high).alias("high"))
            for c, (low, high) in bounds.items()
        )
    )
    v, (low, high) = F.col("v"), ends
    near = F.col("near")
    # The quotient may round across an edge; the edges as reported decide.
    exact = F.when(v < edge(near, low, high), near - 1).when(v >= edge(near + 1, low, high), near + 1).otherwise(near)
    counts = (
        finite.select(F.explode(cells).alias("cell"))
        .select("cell.*")
        .filter(v.isNotNull())
        .withColumn("near", F.floor((v - low) / (high - low) * bins))
        .groupBy("column", F.least(exact, F.lit(bins - 1)).cast("int").alias("bin"))
        .agg(F.count("*").alias("n"))
    )
    joined = all_bins.join(counts, ["column", "bin"], "left")
    return joined.select("column", "bin", "low", "high", F.coalesce("n", F.lit(0)).cast("bigint").alias("n"))
