"""File systems inside tasks, and the footers of many Parquet files read by one job."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Mapping, Sequence
from urllib.parse import urlsplit

import pyarrow as pa
from pyspark.sql import SparkSession

# Session settings of an object store, and the names that Arrow has for them.
STORE_SETTINGS = {
    "fs.s3a.endpoint": "endpoint_override",
    "fs.s3a.access.key": "access_key",
    "fs.s3a.secret.key": "secret_key",
    "fs.s3a.endpoint.region": "region",
}
OPENED = ("", "file", "hdfs", "s3", "s3a")

# Fixed value: where Spark keeps its own schema in a footer.
SPARK_SCHEMA = b"org.apache.spark.sql.parquet.row.metadata"


def store_settings(spark: SparkSession) -> dict[str, str]:
    """What the session says about its object store, to be sent to tasks."""
    conf = spark._jsc.hadoopConfiguration()
    found = {arrow: conf.get(name) for name, arrow in STORE_SETTINGS.items()}
    if conf.get("fs.s3a.connection.ssl.enabled") == "false":
        found["scheme"] = "http"
    return {name: value for name, value in found.items() if value}


def arrow_filesystem(uri: str, settings: Mapping[str, str] | None = None):
    """The Arrow file system of a path and the path in it; a path without a scheme is a local one."""
    from pyarrow import fs

    scheme = urlsplit(uri).scheme if ":" in uri.split("/", 1)[0] else ""
    if scheme in ("", "file"):
        return fs.LocalFileSystem(), uri if not scheme else "/" + uri.removeprefix("file:").lstrip("/")
    if scheme not in ("s3", "s3a") or not settings:
        return fs.FileSystem.from_uri(uri.replace("s3a://", "s3://", 1))
    # Own object stores are asked by path; Arrow does so wherever an endpoint is given.
    options = dict(settings)
    if "://" in options.get("endpoint_override", ""):
        options["scheme"], options["endpoint_override"] = options["endpoint_override"].rstrip("/").split("://", 1)
    return fs.S3FileSystem(**options), uri.split("://", 1)[1]


def can_open(uri: str) -> bool:
    return (urlsplit(uri).scheme if ":" in uri.split("/", 1)[0] else "") in OPENED


def footer_keys(spark: SparkSession, files: Sequence[str]) -> dict[str, str]:
    """A key per Parquet file that is equal where the schemas are; one job, one footer read per file."""
    settings = store_settings(spark)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import parquet

        for batch in batches:
            keys = []
            for path in batch.column("path").to_pylist():
                system, place = arrow_filesystem(path, settings)
                with system.open_input_file(place) as file:
                    meta = parquet.read_metadata(file)
                # The first line of a printed schema names the object.
                told = str(meta.schema).split("\n", 1)[1].encode() + (meta.metadata or {}).get(SPARK_SCHEMA, b"")
                keys.append(hashlib.sha256(told).hexdigest())
            yield pa.RecordBatch.from_arrays([batch.column("path"), pa.array(keys, pa.string())], names=["path", "key"])

    listed = spark.createDataFrame([(f,) for f in files], "path string")
    tasks = min(len(files), 4 * spark.sparkContext.defaultParallelism)
    found = listed.repartition(tasks).mapInArrow(run, "path string, key string")
    return {r["path"]: r["key"] for r in found.collect()}  # as many as the paths that the driver listed
