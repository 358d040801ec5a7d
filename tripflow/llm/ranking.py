"""Ranks and running sums inside groups of any size, one hot group included."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Most distinct values of `shuffle_slot`, from the first four hex digits of its key.
SLOTS = 65_536

# Rows that one cell of a group should hold.
CELL_ROWS = 5_000


def numbered_names(df: DataFrame) -> DataFrame:
    """The same columns as c0, c1 and so on, whatever their names hold."""
    return df.toDF(*[f"c{i}" for i in range(len(df.columns))])


def sortable(df: DataFrame) -> list[str]:
    """The columns that can be ordered and hashed: those without maps and variants."""
    kinds = ((f.name, f.dataType.simpleString()) for f in df.schema.fields)
    return [name for name, kind in kinds if "map<" not in kind and "variant" not in kind]


def map_batches(df: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: T.StructType) -> DataFrame:
    """`mapInArrow` for columns of any name, a dot included."""
    names = df.columns

    def renamed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return run(batch.rename_columns(names) for batch in batches)

    return numbered_names(df).mapInArrow(renamed, schema)


def shuffle_key(seed: int, column: Column) -> Column:
    """A seeded pseudo-random sort key; null columns get a key of their own."""
    return F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(column.cast("string"), F.lit("null"))))


def shuffle_slot(key: Column, slots: int) -> Column:
    """The place of a hex key among `slots` equal ranges of keys."""
    lead = F.conv(F.substring(key, 1, 4), 16, 10).cast("int")
    return F.floor(lead * F.lit(min(slots, SLOTS)) / F.lit(SLOTS)).cast("int")


def slots_for(rows: int) -> int:
    return max(1, min(SLOTS, -(-rows // CELL_ROWS)))


def same(left: DataFrame, right: DataFrame, names: Sequence[str]) -> Column:
    """Null-safe equality of several columns, for a join."""
    condition = F.lit(True)
    for name in names:
        condition = condition & left[name].eqNullSafe(right[name])
    return condition


def rank_in_groups(
    df: DataFrame,
    group: Sequence[str],
    slot: str,
    order: Sequence[str | Column],
    rank: str = "rank",
    value: str | None = None,
    before: str = "before",
) -> DataFrame:
    """Adds the place of each row in its group, from 0, and the sum of `value` over the rows before it.

    `slot` splits every group into cells and must grow with `order`, so that
    the rows of a cell follow the rows of all lower cells. Each cell is
    counted on its own, and gets the totals of the cells before it; no group
    has to fit one task. `df` is read twice: pass a stored frame. Rows that
    `order` doesn't tell apart are placed in any order.
    """
    group = list(group)
    cell = [*group, slot]
    sums = [F.count(F.lit(1)).alias("__n"), *([F.sum(value).alias("__v")] if value else [])]
    earlier = Window.partitionBy(*group).orderBy(slot).rowsBetween(Window.unboundedPreceding, -1)
    cells = df.groupBy(*cell).agg(*sums)
    cells = cells.select(
        *[F.col(c).alias(f"__{c}") for c in cell],
        F.coalesce(F.sum("__n").over(earlier), F.lit(0)).alias("__first"),
        *([F.coalesce(F.sum("__v").over(earlier), F.lit(0)).alias("__sum")] if value else []),
    )
    condition = F.lit(True)
    for c in cell:
        condition = condition & df[c].eqNullSafe(cells[f"__{c}"])
    inside = Window.partitionBy(*cell).orderBy(*order)
    out = df.join(cells, condition)
    columns = [*[df[f"`{c}`"] for c in df.columns], (F.row_number().over(inside) - 1 + F.col("__first")).cast("long").alias(rank)]
    if value:
        running = inside.rowsBetween(Window.unboundedPreceding, -1)
        columns.append((F.coalesce(F.sum(value).over(running), F.lit(0)) + F.col("__sum")).cast("long").alias(before))
    return out.select(*columns)
