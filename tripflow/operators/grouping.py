"""Grouped collection and one-row-per-key selection that hold up with hot keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripflow.operators.joins import attach_per_key
from tripflow.operators.ordered import number_rows


def collect_values(
    df: DataFrame, key: str, value: str, max_list: int, out: str = "items", ranges: int | None = None
) -> DataFrame:
    """The values of every key as sorted arrays (key, segment, out).

    A key with up to `max_list` values gives one array, segment 0. A larger key
    gives several, in order, so that no group has to fit one task or one row.
    As with collect_list, nulls are left out and a key with nulls alone gets an
    empty array.
    """
    rows = df.select(F.col(key), F.col(value).isNull().alias("__unknown"), F.col(value))
    placed = number_rows(rows, [key, "__unknown", value], "__number", ranges)
    starts = placed.groupBy(F.col(key).alias("__key")).agg(
        F.min("__number").alias("__start"), F.count(F.lit(1)).alias("__n")
    )
    cut = attach_per_key(placed, starts, [(key, "__key")], "__n", ranges).withColumn(
        "segment", F.expr(f"(__number - __start) div {max_list}")
    )
    lists = cut.groupBy(key, "segment").agg(F.sort_array(F.collect_list(value)).alias(out))
    return lists.filter((F.col("segment") == 0) | (F.size(out) > 0))


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The row of every key that comes first by `order`, ties broken by the other columns.

    A min over structs: partial aggregation leaves one candidate per key and
    task before the shuffle, where a row_number window would move whole groups.
    """
    names = {c.lower() for c in keys}
    rest = [c for c in df.columns if c.lower() not in names | {c.lower() for c in order}]
    best = df.groupBy(*keys).agg(F.min(F.struct(*order, *rest)).alias("__best"))
    return best.select(*(F.col(c) if c.lower() in names else F.col(f"__best.{c}").alias(c) for c in df.columns))


def word_counts(lines: DataFrame, column: str = "value", delimiter: str = " ") -> DataFrame:
    """How often each delimited word occurs; counted before the shuffle."""
    words = lines.select(F.explode(F.split(F.col(column), delimiter)).alias("word"))
    return words.groupBy("word").agg(F.count("*").alias("n"))
