"""Stream sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def kafka_options(servers: str, topic: str, starting_offsets: str = "earliest") -> dict[str, str]:
    return {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": starting_offsets,
    }


def read_kafka(spark: SparkSession, servers: str, topic: str, starting_offsets: str = "earliest") -> DataFrame:
    """A topic as a stream; needs the Kafka connector on the class path."""
    return spark.readStream.format("kafka").options(**kafka_options(servers, topic, starting_offsets)).load()


def read_stream_folder(
    spark: SparkSession,
    directory: str,
    schema: str | StructType,
    fmt: str = "parquet",
    pattern: str | None = None,
    max_files: int | None = None,
) -> DataFrame:
    """New files of a folder as a stream, at most `max_files` per micro-batch."""
    reader = spark.readStream.format(fmt).schema(schema)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(directory)
