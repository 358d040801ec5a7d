"""Column expressions built from Spark's own functions, so they stay in generated code."""

from __future__ import annotations

import functools
import operator
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StringType


def elapsed_minutes(start: str, end: str) -> Column:
    """Minutes between two timestamps as a double; sub-second parts are cut off first."""
    return (F.unix_timestamp(F.col(end)) - F.unix_timestamp(F.col(start))) / F.lit(60.0)


def elapsed_whole_minutes(start: str, end: str) -> Column:
    """Full minutes that passed between two timestamps."""
    return F.expr(f"timestampdiff(MINUTE, `{start}`, `{end}`)")


def guarded_ratio(numerator: Column, denominator: Column) -> Column:
    """numerator / denominator, and 0 wherever the denominator is not above 0."""
    return F.when(denominator > 0, numerator / denominator).otherwise(0)


def fee_total(columns: Sequence[str]) -> Column:
    """Sum of the fee columns at two decimals; one missing fee leaves the total unknown."""
    return F.round(functools.reduce(operator.add, (F.col(c) for c in columns)), 2)


def split_part_at(column: str, delimiter: str, index: int) -> Column:
    """0-based part of a split text, null where there are fewer parts."""
    return F.get(F.split(F.col(column), delimiter), index)


def to_type(column: Column, source: DataType, target: str) -> Column:
    """Cast that yields null for a value that does not fit.

    Text with a fractional part becomes a whole number by cutting the fraction.
    """
    if isinstance(source, StringType) and target in ("int", "bigint"):
        column = column.try_cast("decimal(38,10)")
    return column.try_cast(target)


def banded(value: Column, bands: Sequence[tuple[float, str]], above: str) -> Column:
    """The label of the first band whose upper bound, itself included, is not below the value; null has none."""
    labels = F.array(*[F.struct(F.lit(float(bound)).alias("bound"), F.lit(label).alias("label")) for bound, label in bands])
    reached = F.filter(labels, lambda band: value <= band["bound"])
    return F.when(value.isNotNull(), F.coalesce(F.get(reached, F.lit(0))["label"], F.lit(above)))
