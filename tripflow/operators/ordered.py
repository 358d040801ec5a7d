"""Numbering, ranks and running totals, over the table or within groups, without a one-task window.

A window without PARTITION BY moves every row to one task. Here the rows are
range-partitioned by the order, each range is numbered or summed on its own, and
the totals of the ranges before it (one row per range) are added:

    position(row) = rows in earlier ranges + position within the range

The ranged rows are written to the shared folder in between. Range bounds come
from a sample that may differ between two runs of the same plan, so totals and
rows must be read from one copy; it also cuts the lineage, and the totals read
only their own columns of it.

Within groups the rows are ranged by (group, order), so a group of any size
covers neighbouring ranges, and many small ones share a range. Numbers and totals start again
with each group: only the first group of a range can have begun before it, and
the totals of its earlier ranges are one row per range again.

Hot order keys: ranks and RANGE totals first aggregate to one row per order key
and are joined back with the hot keys split off. Numbering and ROWS totals break
ties by all other columns, so rows that share an order key still spread over
ranges. Only identical rows cannot be told apart; where a group of them is large
its copies are counted, carried as one row and expanded again in parallel. Where
they can't be (columns without an order, decimals too wide for a product) the rows
are numbered, and the number is the last order key.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, DecimalType, MapType, StructType, VariantType

from tripflow.operators.joins import attach_per_key
from tripflow.operators.skew import HOT_ROWS, has_hot_group
from tripflow.session import materialise, shuffle_parts

RANGE = "__range"
POSITION = "__position"
COPIES = "__copies"
COPY = "__copy"
TIE = "__tie"

# Copies expanded by one task from one row.
COPY_CHUNK = 100_000
# Digits that a product with a bigint adds to a decimal.
COUNT_DIGITS = 21


@dataclass(frozen=True)
class Key:
    """An order key; ascending puts nulls first, descending last."""

    name: str
    ascending: bool = True

    def column(self) -> Column:
        return F.col(self.name).asc() if self.ascending else F.col(self.name).desc()


def as_keys(order: Sequence[str | Key]) -> list[Key]:
    return [k if isinstance(k, Key) else Key(k) for k in order]


def row_keys(df: DataFrame, order: Sequence[str | Key], groups: Sequence[str] = ()) -> list[Key]:
    """The groups and the order, then every other column that can be ordered as a tie-breaker."""
    keys = as_keys([*groups, *order])
    named = {k.name.lower() for k in keys}
    return keys + [Key(f.name) for f in df.schema.fields if f.name.lower() not in named and _can_be_ordered(f.dataType)]


def _can_be_ordered(kind: DataType) -> bool:
    if isinstance(kind, StructType):
        return all(_can_be_ordered(f.dataType) for f in kind.fields)
    return _can_be_ordered(kind.elementType) if isinstance(kind, ArrayType) else not isinstance(kind, (MapType, VariantType))


def _has_hot_copies(df: DataFrame, keys: Sequence[Key], ranges: int | None, hot_copies: int) -> bool:
    """Whether identical rows have to be folded; rows with maps can't be told to be identical and never are.

    Copies share their order key, so all columns are read only where some key is hot.
    """
    if not all(_can_be_ordered(f.dataType) for f in df.schema.fields):
        return False
    named = [k.name for k in keys]
    return has_hot_group(df, named, ranges, hot_copies) and has_hot_group(df, df.columns, ranges, hot_copies)


def _unfolded(
    df: DataFrame, keys: Sequence[Key], ranges: int | None, hot_copies: int, exact: bool = True
) -> tuple[DataFrame, list[Key]]:
    """Rows that are not folded, and their keys; those of a large group of equal keys get a number of their own.

    The numbers are written once, since ranges and rows have to see the same.
    """
    known = exact and all(_can_be_ordered(f.dataType) for f in df.schema.fields)  # then found to hold no such group
    if known or not has_hot_group(df, [k.name for k in keys], ranges, hot_copies):
        return df, list(keys)
    return materialise(df.withColumn(TIE, F.monotonically_increasing_id())), [*keys, Key(TIE)]


def _ranged(df: DataFrame, keys: Sequence[Key], ranges: int | None) -> DataFrame:
    """Rows in ranges of the order, each with its range and its position there; written once.

    Without a number of ranges there are as many as shuffle partitions, and AQE
    joins small neighbours.
    """
    order = [k.column() for k in keys]
    split = df.repartitionByRange(ranges, *order) if ranges else df.repartitionByRange(*order)
    placed = split.sortWithinPartitions(*order)
    # The generated id counts rows within a partition in its lower 33 bits.
    position = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    return materialise(placed.select("*", F.spark_partition_id().alias(RANGE), position.alias(POSITION)))


def _group_offsets(ranged: DataFrame, sums: Sequence[str], groups: Sequence[str]) -> DataFrame:
    """For every range whose first group began before it, that group's totals of the earlier ranges."""
    earlier = Window.partitionBy(*groups).orderBy(RANGE).rowsBetween(Window.unboundedPreceding, -1)
    totals = ranged.groupBy(RANGE, *groups).agg(F.count(F.lit(1)).alias("__rows"), *(F.sum(c).alias(c) for c in sums))
    return totals.select(
        F.col(RANGE).alias("__of"),
        *(F.col(g).alias(f"__group{i}") for i, g in enumerate(groups)),
        F.sum("__rows").over(earlier).alias("__begun"),
        *(F.coalesce(F.sum(c).over(earlier), F.lit(0)).alias(f"__offset_{c}") for c in sums),
    ).filter("__begun IS NOT NULL")


def _offsets(ranged: DataFrame, sums: dict[str, Column]) -> DataFrame:
    """For every range the totals of all earlier ones: one row per range, whatever the table's size."""
    earlier = Window.orderBy(RANGE).rowsBetween(Window.unboundedPreceding, -1)
    totals = ranged.groupBy(RANGE).agg(*(column.alias(name) for name, column in sums.items()))
    return totals.select(
        RANGE, *(F.coalesce(F.sum(name).over(earlier), F.lit(0)).alias(f"__offset_{name}") for name in sums)
    )


def _with_sums_before(
    units: DataFrame, keys: Sequence[Key], sums: Sequence[str], ranges: int | None, groups: Sequence[str] = ()
) -> DataFrame:
    """Adds before_<c> for every c in sums: the sum over all rows (of the group) that sort earlier; the groups lead the keys."""
    ranged = _ranged(units, keys, ranges)
    last = ranged.agg(F.max(RANGE)).first()[0] or 0
    within = Window.partitionBy(RANGE, *groups).orderBy(POSITION).rowsBetween(Window.unboundedPreceding, -1)
    # One task per range; hashing the range numbers would put several into one task.
    alone = ranged.repartitionById(last + 1, RANGE)
    local = alone.select("*", *(F.coalesce(F.sum(c).over(within), F.lit(0)).alias(f"__local_{c}") for c in sums))
    before = lambda c: _added(F.col(f"__offset_{c}"), F.col(f"__local_{c}"), local.schema[f"__local_{c}"].dataType)
    if not groups:
        offsets = _offsets(ranged, {c: F.sum(c) for c in sums})
        return local.join(F.broadcast(offsets), RANGE).select(*units.columns, *(before(c).alias(f"before_{c}") for c in sums))
    own = F.col(RANGE) == F.col("__of")
    for i, g in enumerate(groups):
        own = own & F.col(g).eqNullSafe(F.col(f"__group{i}"))
    joined = local.join(F.broadcast(_group_offsets(ranged, sums, groups)), own, "left")
    added = (F.when(F.col("__begun").isNull(), F.col(f"__local_{c}")).otherwise(before(c)) for c in sums)
    return joined.select(*units.columns, *(a.alias(f"before_{c}") for a, c in zip(added, sums)))


def _added(a: Column, b: Column, kind: DataType) -> Column:
    """a + b; of the widest decimals as 37 digits, since a sum of 38 digits would lose one behind the point."""
    if isinstance(kind, DecimalType) and kind.precision == 38:
        narrow = DecimalType(kind.precision - 1, kind.scale)
        return a.cast(narrow) + b.cast(narrow)
    return a + b


def _fold_copies(df: DataFrame) -> DataFrame:
    """Identical rows as one row with their number; counted before the shuffle."""
    return df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias(COPIES))


def _expand_copies(df: DataFrame, chunk: int) -> DataFrame:
    """One row per copy, numbered from 0; large groups are cut into chunks that spread over tasks.

    The number of those tasks is fixed: AQE would join them, as the few rows
    that stand for the chunks look small before they are expanded.
    """
    zero = F.lit(0).cast("bigint")
    few = df.filter(F.col(COPIES) <= chunk).select("*", F.explode(F.sequence(zero, F.col(COPIES) - 1)).alias(COPY))
    chunks = F.explode(F.sequence(zero, F.expr(f"({COPIES} - 1) div {chunk}")))
    first = F.col("__chunk") * chunk
    last = F.least(first + chunk, F.col(COPIES)) - 1
    many = (
        df.filter(F.col(COPIES) > chunk)
        .select("*", chunks.alias("__chunk"))
        .repartition(shuffle_parts(df.sparkSession), F.xxhash64(f"before_{COPIES}", "__chunk"))
        .select("*", F.explode(F.sequence(first, last)).alias(COPY))
        .drop("__chunk")
    )
    return few.unionByName(many)


def number_rows(
    df: DataFrame,
    order: Sequence[str | Key],
    out: str = "row_number",
    ranges: int | None = None,
    hot_copies: int = HOT_ROWS,
    chunk: int = COPY_CHUNK,
    groups: Sequence[str] = (),
) -> DataFrame:
    """ROW_NUMBER() OVER ([PARTITION BY groups] ORDER BY order, then all other columns)."""
    keys = row_keys(df, order, groups)
    if _has_hot_copies(df, as_keys([*groups, *order]), ranges, hot_copies):
        return _number_folded(df, keys, out, ranges, chunk, groups)
    rows, keys = _unfolded(df, keys, ranges, hot_copies)
    if groups:
        counted = _with_sums_before(rows.withColumn(COPIES, F.lit(1).cast("bigint")), keys, [COPIES], ranges, groups)
        return counted.select(*df.columns, (F.col(f"before_{COPIES}") + 1).alias(out))
    ranged = _ranged(rows, keys, ranges)
    offsets = _offsets(ranged, {"n": F.count(F.lit(1))})
    number = F.col("__offset_n") + F.col(POSITION) + 1
    return ranged.join(F.broadcast(offsets), RANGE).select(*df.columns, number.alias(out))


def _number_folded(
    df: DataFrame, keys: Sequence[Key], out: str, ranges: int | None, chunk: int, groups: Sequence[str] = ()
) -> DataFrame:
    placed = _with_sums_before(_fold_copies(df), keys, [COPIES], ranges, groups)
    number = F.col(f"before_{COPIES}") + F.col(COPY) + 1
    return _expand_copies(placed, chunk).select(*df.columns, number.alias(out))


def _per_key(df: DataFrame, keys: Sequence[Key], *aggs: Column) -> tuple[DataFrame, list[Key]]:
    """One row per order key, under names that cannot clash with the rows joined later."""
    renamed = [Key(f"__key{i}", k.ascending) for i, k in enumerate(keys)]
    columns = [F.col(k.name).alias(r.name) for k, r in zip(keys, renamed)]
    return df.groupBy(*columns).agg(F.count(F.lit(1)).alias("__n"), *aggs), renamed


def rank_rows(
    df: DataFrame,
    order: Sequence[str | Key],
    rank: str = "rank",
    dense_rank: str = "dense_rank",
    ranges: int | None = None,
    groups: Sequence[str] = (),
) -> DataFrame:
    """RANK() and DENSE_RANK() OVER ([PARTITION BY groups] ORDER BY order)."""
    keys = as_keys([*groups, *order])
    peers, renamed = _per_key(df, keys)
    own = [k.name for k in renamed[: len(groups)]]
    placed = _with_sums_before(peers.withColumn("__one", F.lit(1).cast("bigint")), renamed, ["__n", "__one"], ranges, own)
    ranked = placed.select(
        *(r.name for r in renamed),
        "__n",
        (F.col("before___n") + 1).alias("__rank"),
        (F.col("before___one") + 1).alias("__dense_rank"),
    )
    joined = attach_per_key(df, ranked, [(k.name, r.name) for k, r in zip(keys, renamed)], "__n", ranges)
    return joined.select(
        *(F.col(c) for c in df.columns), F.col("__rank").alias(rank), F.col("__dense_rank").alias(dense_rank)
    )


def running_total(
    df: DataFrame,
    value: str,
    order: Sequence[str | Key],
    out: str = "running_total",
    frame: str = "rows",
    ranges: int | None = None,
    hot_copies: int = HOT_ROWS,
    chunk: int = COPY_CHUNK,
    groups: Sequence[str] = (),
) -> DataFrame:
    """SUM(value) OVER ([PARTITION BY groups] ORDER BY order ROWS | RANGE UNBOUNDED PRECEDING).

    ROWS adds row by row, ties broken by all other columns; RANGE gives rows
    with equal order keys the same total. Null until the first known value.
    """
    if frame == "rows":
        return _running_rows(df, value, order, out, ranges, hot_copies, chunk, groups)
    if frame == "range":
        return _running_range(df, value, order, out, ranges, groups)
    raise ValueError(f"unknown frame {frame!r}")


def _running_rows(
    df: DataFrame, value: str, order: Sequence[str | Key], out: str, ranges: int | None, hot_copies: int, chunk: int,
    groups: Sequence[str],
) -> DataFrame:
    keys = row_keys(df, order, groups)
    result = df.select(F.sum(value).alias(out)).schema[0].dataType
    # A wide decimal times a count would lose digits: its copies are added one by one.
    kind = df.schema[value].dataType
    exact = not isinstance(kind, DecimalType) or kind.precision + COUNT_DIGITS <= 38
    folded = exact and _has_hot_copies(df, as_keys([*groups, *order]), ranges, hot_copies)
    if folded:
        units = _fold_copies(df)
    else:
        units, keys = _unfolded(df, keys, ranges, hot_copies, exact)
        units = units.withColumn(COPIES, F.lit(1).cast("bigint"))
    times = (lambda n: F.col(value) * n) if folded else (lambda n: F.col(value).cast(result))
    known = F.col(value).isNotNull().cast("bigint")
    units = units.withColumns(
        {"__sum": F.coalesce(times(F.col(COPIES)), F.lit(0).cast(result)), "__known": known * F.col(COPIES)}
    )
    rows = _with_sums_before(units, keys, [COPIES, "__sum", "__known"] if folded else ["__sum", "__known"], ranges, groups)
    rows = _expand_copies(rows, chunk) if folded else rows.withColumn(COPY, F.lit(0).cast("bigint"))
    own = F.coalesce(times(F.col(COPY) + 1), F.lit(0).cast(result))
    total = F.when(F.col("before___known") + known > 0, _added(F.col("before___sum").cast(result), own.cast(result), result).cast(result))
    return rows.select(*df.columns, total.alias(out))


def _running_range(
    df: DataFrame, value: str, order: Sequence[str | Key], out: str, ranges: int | None, groups: Sequence[str]
) -> DataFrame:
    keys = as_keys([*groups, *order])
    peers, renamed = _per_key(
        df, keys, F.coalesce(F.sum(value), F.lit(0)).alias("__sum"), F.count(value).alias("__known")
    )
    placed = _with_sums_before(peers, renamed, ["__sum", "__known"], ranges, [k.name for k in renamed[: len(groups)]])
    total = F.when(F.col("before___known") + F.col("__known") > 0, F.col("before___sum") + F.col("__sum"))
    totals = placed.select(*(r.name for r in renamed), "__n", total.alias("__total"))
    joined = attach_per_key(df, totals, [(k.name, r.name) for k, r in zip(keys, renamed)], "__n", ranges)
    return joined.select(*(F.col(c) for c in df.columns), F.col("__total").alias(out))


def with_total(df: DataFrame, value: str, out: str = "total") -> DataFrame:
    """SUM(value) OVER () as a scalar subquery: one aggregate, no shuffle of the rows."""
    return df.select("*", df.agg(F.sum(value)).scalar().alias(out))


def sort_rows(
    df: DataFrame,
    order: Sequence[str | Key],
    ranges: int | None = None,
    hot_copies: int = HOT_ROWS,
    chunk: int = COPY_CHUNK,
) -> DataFrame:
    """Global sort; ties are ordered by the other columns, so equal keys spread over tasks.

    Where a large group of identical rows exists the rows are spread by their position instead.
    """
    keys = row_keys(df, order)
    if not _has_hot_copies(df, as_keys(order), ranges, hot_copies):
        rows, keys = _unfolded(df, keys, ranges, hot_copies)
        return rows.orderBy(*(k.column() for k in keys)).select(*df.columns)
    return _number_folded(df, keys, "__number", ranges, chunk).orderBy("__number").drop("__number")
