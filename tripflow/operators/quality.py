"""Row quality rules."""

from __future__ import annotations

import functools
import operator
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripflow.functions.expressions import elapsed_minutes


def quality_gate(df: DataFrame, not_null: Sequence[str] = (), non_negative: Sequence[str] = ()) -> DataFrame:
    """Keep the rows that have all `not_null` values and no negative `non_negative` value.

    A comparison with null is unknown, so a missing `non_negative` value drops the row too.
    """
    tests = [F.col(c).isNotNull() for c in not_null] + [F.col(c) >= 0 for c in non_negative]
    return df.filter(functools.reduce(operator.and_, tests)) if tests else df


def with_positive_duration(
    df: DataFrame, start: str, end: str, out: str = "trip_duration_minutes"
) -> DataFrame:
    """Add the trip length in minutes and keep the trips that took time."""
    return df.withColumn(out, elapsed_minutes(start, end)).filter(F.col(out) > 0)
