"""Finding groups too large for one task, without a shuffle of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripflow.session import shuffle_parts

# Groups up to this many rows never need splitting.
HOT_ROWS = 1_000_000

# Buckets of hashes that are counted, per part: an even bucket stays far below an even part.
BUCKETS_PER_PART = 64


def has_hot_group(
    df: DataFrame, columns: Sequence[str], parts: int | None = None, hot_rows: int = HOT_ROWS
) -> bool:
    """Whether some group of rows equal in `columns` holds more than an even part of all rows.

    One pass that counts rows per bucket of hashes before it shuffles them, one
    row per bucket and task. A group's rows share a bucket, so such a group
    cannot be missed; it only steers the plan, never what comes out.
    """
    parts = parts or shuffle_parts(df.sparkSession)
    bucket = F.pmod(F.xxhash64(*columns), F.lit(BUCKETS_PER_PART * parts))
    counts = df.select(bucket.alias("bucket")).groupBy("bucket").count()
    rows, most = counts.agg(F.sum("count"), F.max("count")).first()
    return bool(rows) and most > max(hot_rows, rows // parts)
