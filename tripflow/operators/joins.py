"""Joins that hold up with hot keys, and lookups broadcast only when they are small."""

from __future__ import annotations

import functools
import operator
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripflow.operators.skew import HOT_ROWS, has_hot_group
from tripflow.session import shuffle_parts

MAX_BROADCAST_ROWS = 100_000
MAX_BROADCAST_BYTES = 64 << 20


def is_small(df: DataFrame, max_rows: int = MAX_BROADCAST_ROWS, max_bytes: int = MAX_BROADCAST_BYTES) -> bool:
    """Whether a side is safe to broadcast, by its rows and their size as JSON.

    Reads one partition, then a few more at a time, and stops at the bound of
    rows; the driver receives the sizes alone.
    """
    size = F.octet_length(F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns])))
    sizes = [r[0] for r in df.select(size).take(max_rows + 1)]
    return len(sizes) <= max_rows and sum(sizes) <= max_bytes


def _all_equal(pairs: Sequence[tuple[str, str]]) -> Column:
    return functools.reduce(operator.and_, (F.col(a).eqNullSafe(F.col(b)) for a, b in pairs))


def attach_per_key(
    rows: DataFrame,
    per_key: DataFrame,
    pairs: Sequence[tuple[str, str]],
    count: str,
    parts: int | None = None,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Join rows to the one row per key that was aggregated from them; null is a key too.

    `count` holds the rows of each key. Keys with more than 1/parts of all rows,
    of which there are fewer than `parts`, are joined by broadcast and never
    shuffled; all other keys are small enough for a shuffled join.
    """
    same = _all_equal(pairs)
    parts = parts or shuffle_parts(rows.sparkSession)
    total, largest = per_key.agg(F.sum(count), F.max(count)).first()
    bound = max(hot_rows, (total or 0) // parts)
    if (largest or 0) <= bound:
        return rows.join(per_key, same)
    hot = F.broadcast(per_key.filter(F.col(count) > bound))
    cold = per_key.filter(F.col(count) <= bound)
    return rows.join(hot, same).unionByName(rows.join(hot, same, "left_anti").join(cold, same))


def outer_join(
    left: DataFrame,
    right: DataFrame,
    pairs: Sequence[tuple[str, str]],
    how: str = "left",
    parts: int | None = None,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Left or right outer equi-join on (left, right) column pairs; all column names must differ.

    In an outer join AQE can split a hot key of the preserved side only. Where
    the other side has one, the matches come from an inner join, which can be
    split on both sides, and the preserved rows without a match are added.
    """
    if how not in ("left", "right"):
        raise ValueError(f"unknown outer join {how!r}")
    same = functools.reduce(operator.and_, (F.col(a) == F.col(b) for a, b in pairs))
    preserved, other = (left, right) if how == "left" else (right, left)
    keys = other.select(*(p[1] if how == "left" else p[0] for p in pairs)).dropna()
    if not has_hot_group(keys, keys.columns, parts, hot_rows):
        return left.join(right, same, how)
    unmatched = preserved.join(keys.distinct(), same, "left_anti")
    return left.join(right, same, "inner").unionByName(unmatched, allowMissingColumns=True)


def enrich_zones(
    trips: DataFrame,
    zones: DataFrame,
    zone_key: str,
    roles: Mapping[str, str],
    attributes: Sequence[str],
    max_rows: int = MAX_BROADCAST_ROWS,
) -> DataFrame:
    """Join one lookup once per role; `roles` maps an output prefix to the trip column.

    Left outer: a trip with an unknown or missing location keeps null attributes.
    The lookup must hold one row per key. It is broadcast if its rows and bytes, which
    are checked, allow that; otherwise the joins shuffle, and AQE splits hot zones.
    """
    lookup = zones.select(zone_key, *attributes)
    small = is_small(lookup, max_rows)
    joined = trips
    for prefix, location in roles.items():
        role = lookup.select(
            F.col(zone_key).alias(f"__{prefix}_key"), *(F.col(a).alias(f"{prefix}{a}") for a in attributes)
        )
        if small:
            role = F.broadcast(role)
        joined = joined.join(role, F.col(location) == F.col(f"__{prefix}_key"), "left").drop(f"__{prefix}_key")
    return joined
