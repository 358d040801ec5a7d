"""File and table sinks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripflow.sources.files import read_csv

SAVE_MODES = ("append", "overwrite", "errorifexists", "error", "ignore")


def save(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "errorifexists", **options: object) -> None:
    """Write files. The default refuses a path that already exists."""
    if mode not in SAVE_MODES:
        raise ValueError(f"unknown save mode {mode!r}")
    df.write.format(fmt).mode(mode).options(**options).save(path)


def clustered(df: DataFrame, by: Sequence[str], file_rows: int, rows: int | None = None) -> DataFrame:
    """The rows ranged and ordered by some columns, about `file_rows` to a range, so that a filter on these skips files.

    Rows that the columns don't tell apart are spread by a hash of all their columns, so a hot value covers many
    ranges. Writers should add `maxRecordsPerFile`, which cuts ranges of identical rows. `rows` is their number, if known.
    """
    if file_rows < 1:
        raise ValueError("a file holds a row at least")
    names = [F.col(f"`{c}`") for c in df.columns]
    files = max(1, -(-(df.count() if rows is None else rows) // file_rows))
    order = [*(F.col(f"`{c}`") for c in by), F.xxhash64(*names)]
    return df.repartitionByRange(files, *order).sortWithinPartitions(*order)


def publish_table(df: DataFrame, name: str, **options: object) -> None:
    """Create the table or replace all of it.

    A catalog that can replace a table in one step does so. The session
    catalog cannot; there the managed table is overwritten, and readers may
    miss it while the new files are written.
    """
    if name.count(".") >= 2 and not name.startswith("spark_catalog."):
        df.writeTo(name).options(**options).createOrReplace()
    else:
        df.write.mode("overwrite").format("parquet").options(**options).saveAsTable(name)


VERSION = "__v"


def publish_version(df: DataFrame, name: str, keep: int = 2) -> str:
    """Write a new version of a table and turn its name to it in one step; returns the version's name.

    On a catalog without atomic replacement the name is a view over the tables
    `name__v1`, `name__v2`, ...: readers see the last version until the new one is whole, and
    never miss the name. A reader that planned before the turn goes on with its
    version, so the last `keep` versions stay and older ones are dropped. A failed write leaves the view as it was.
    """
    if keep < 1:
        raise ValueError("the version that is read has to stay")
    spark = df.sparkSession
    namespace, _, base = name.rpartition(".")
    below = f"{namespace}." if namespace else ""
    versions = _versions(spark, namespace, base)
    made = f"{below}{base}{VERSION}{max(versions, default=0) + 1}"
    df.write.mode("errorifexists").format("parquet").saveAsTable(made)
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS SELECT * FROM {made}")
    for old in sorted(versions)[: max(0, len(versions) + 1 - keep)]:
        spark.sql(f"DROP TABLE IF EXISTS {below}{base}{VERSION}{old}")
    return made


def _versions(spark: SparkSession, namespace: str, base: str) -> list[int]:
    """The numbers of the versions of a table that the catalog lists."""
    listed = spark.sql(f"SHOW TABLES IN {namespace}" if namespace else "SHOW TABLES").collect()  # names of one namespace
    lead = f"{base}{VERSION}".lower()
    ends = [r["tableName"].removeprefix(lead) for r in listed if r["tableName"].startswith(lead)]
    return [int(e) for e in ends if e.isdigit()]


def ingest(spark: SparkSession, source: str, target: str, fmt: str) -> None:
    """Copy a raw input into bronze, from any file system to any other."""
    if fmt == "parquet":
        save(spark.read.parquet(source), target, "parquet", "overwrite")
    elif fmt == "csv":
        save(read_csv(spark, source), target, "csv", "overwrite", header=True)
    else:
        raise ValueError(f"cannot ingest format {fmt!r}")
