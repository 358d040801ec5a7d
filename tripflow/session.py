"""Session building, storage settings and the shared working folder."""

from __future__ import annotations

import configparser
import os
import tempfile
import uuid
from collections.abc import Callable, Iterator, Mapping
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot key even where that costs one more shuffle downstream.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}

# Environment variables that may carry the object-store settings.
STORAGE_ENV = {
    "endpoint": "TRIPFLOW_S3_ENDPOINT",
    "access_key": "TRIPFLOW_S3_ACCESS_KEY",
    "secret_key": "TRIPFLOW_S3_SECRET_KEY",
}


def storage_conf(endpoint: str, access_key: str | None = None, secret_key: str | None = None) -> dict[str, str]:
    """Hadoop S3A settings for an object store addressed by path."""
    conf = {
        "spark.hadoop.fs.s3a.endpoint": endpoint,
        "spark.hadoop.fs.s3a.path.style.access": "true",
        "spark.hadoop.fs.s3a.impl": "org.apache.hadoop.fs.s3a.S3AFileSystem",
        "spark.hadoop.fs.s3a.connection.ssl.enabled": str(endpoint.startswith("https://")).lower(),
    }
    if access_key and secret_key:
        conf["spark.hadoop.fs.s3a.access.key"] = access_key
        conf["spark.hadoop.fs.s3a.secret.key"] = secret_key
    return conf


def load_storage_conf(path: str, section: str = "minio") -> dict[str, str]:
    """S3A settings from an INI file with endpoint, access_key and secret_key."""
    parser = configparser.ConfigParser()
    if not parser.read(path):
        raise FileNotFoundError(path)
    entries = parser[section]
    return storage_conf(entries["endpoint"], entries.get("access_key"), entries.get("secret_key"))


def storage_conf_from_env(environ: Mapping[str, str] | None = None) -> dict[str, str]:
    """S3A settings from the environment; empty when no endpoint is set there."""
    environ = os.environ if environ is None else environ
    if STORAGE_ENV["endpoint"] not in environ:
        return {}
    return storage_conf(*(environ.get(STORAGE_ENV[k]) for k in ("endpoint", "access_key", "secret_key")))


def layer_catalog_conf(warehouses: Mapping[str, str]) -> dict[str, str]:
    """One Iceberg catalog per layer, each with a warehouse of its own (needs the Iceberg runtime)."""
    conf = {}
    for name, warehouse in warehouses.items():
        prefix = f"spark.sql.catalog.{name}"
        conf[prefix] = "org.apache.iceberg.spark.SparkCatalog"
        conf[f"{prefix}.type"] = "hadoop"
        conf[f"{prefix}.warehouse"] = warehouse
    return conf


def scale_conf(input_bytes: int, partition_bytes: int = 1 << 30) -> dict[str, str]:
    """Shuffle settings for an input of a known size.

    There are enough shuffle partitions for the whole input to pass through one
    shuffle at `partition_bytes` each; AQE joins them where less arrives.
    """
    parts = max(200, -(-input_bytes // partition_bytes))
    return {
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(min(partition_bytes // 4, 256 << 20)),
    }


def build_session(
    app_name: str,
    master: str | None = None,
    conf: Mapping[str, str] | None = None,
    storage: Mapping[str, str] | None = None,
) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {**DEFAULT_CONF, **(storage_conf_from_env() if storage is None else storage), **(conf or {})}
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder for checkpoints, as the cluster names it.

    A folder on this machine is taken only in local mode, where driver and
    executors are one process; on a cluster the setting is required.
    """
    context = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if root is None:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="tripflow-")
        context.setCheckpointDir(root)
    return root


def shuffle_parts(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


# The folders of the scopes that are open, the innermost last.
_SCOPES: ContextVar[tuple[list[str], ...]] = ContextVar("tripflow_scopes", default=())


def scratch_path(spark: SparkSession, *labels: str) -> str:
    """A path nobody used yet below the shared folder; removed with the innermost open scope."""
    folder = "/".join([checkpoint_root(spark).rstrip("/"), f"work-{uuid.uuid4().hex}"])
    if scopes := _SCOPES.get():
        scopes[-1].append(folder)
    return "/".join([folder, *labels])


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[Callable[[DataFrame], DataFrame]]:
    """Removes everything that is stored for later within the block, also after an error.

    Frames are read lazily, so one that is needed after the block has to be
    handed to the function that the block gets: it is stored once more, and belongs to
    the scope around this one, or to the caller. Scopes nest, and each thread has its own.
    """
    outer, own = _SCOPES.get(), []
    token = _SCOPES.set((*outer, own))

    def keep(df: DataFrame) -> DataFrame:
        inside = _SCOPES.set(outer)
        try:
            return materialise(df)
        finally:
            _SCOPES.reset(inside)

    try:
        yield keep
    finally:
        _SCOPES.reset(token)
        for folder in own:
            remove(spark, folder)


def remove(spark: SparkSession, folder: str) -> None:
    """Delete a folder on whatever file system it lies; one that is missing is no error."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def materialise(df: DataFrame) -> DataFrame:
    """The frame as a table in the shared folder: cuts the lineage and outlives executors."""
    path = scratch_path(df.sparkSession, "table")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def small_batches(spark: SparkSession, rows: int = 1_024, most: int = 8 << 20) -> Iterator[None]:
    """Within the block, Spark hands Python at most so many rows and bytes of a table at once; a limit that is lower stays.

    Settings are read when a job is planned, so the block has to run it, as `materialise` does.
    """
    limits = {"spark.sql.execution.arrow.maxRecordsPerBatch": rows, "spark.sql.execution.arrow.maxBytesPerBatch": most}
    before = {k: spark.conf.get(k, None) for k in limits}
    try:
        for k, limit in limits.items():
            now = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(before[k] or "0")
            spark.conf.set(k, str(min(now, limit) if now > 0 else limit))
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Within the block, what a query has shuffled is removed when it ends, not when the driver happens to collect garbage."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def unique_name(prefix: str) -> str:
    return f"{prefix}_{uuid.uuid4().hex[:12]}"
