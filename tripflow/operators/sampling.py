"""Samples that do not depend on how the rows are partitioned."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Hex digits of the hash that decide: fractions are kept to one in four billion.
DIGITS = 8


def hash_bound(fraction: float) -> str:
    """The first hash, in hexadecimal, that is left out."""
    if not 0 <= fraction <= 1:
        raise ValueError(f"a fraction lies between 0 and 1, not {fraction}")
    return format(round(fraction * 16**DIGITS), f"0{DIGITS}x")


def sample_by_hash(df: DataFrame, fraction: float, seed: int, keys: Sequence[str] | None = None) -> DataFrame:
    """The rows whose seeded hash of `keys` (of all columns by default) lies below `fraction` of all hashes.

    Spark's own sample draws by partition and position, so another file layout gives
    other rows. This one asks each row alone: it needs no shuffle, keeps its rows in
    any run, layout and order of rows, a larger fraction keeps all rows of a smaller one, and
    rows with equal keys stay or go together. Keys are read as text; a null is a key of its own.
    """
    bound = hash_bound(fraction)
    if len(bound) > DIGITS:
        return df
    named = df.columns if keys is None else keys
    kinds = dict(df.dtypes)
    plain = lambda c: F.col(f"`{c}`").cast("string") if not kinds.get(c, "").startswith(("array", "map", "struct")) else F.to_json(f"`{c}`")
    told = F.concat_ws("|", F.lit(str(seed)), *(F.coalesce(plain(c), F.lit("\0")) for c in named))
    return df.filter(F.substring(F.md5(told), 1, DIGITS) < bound)
