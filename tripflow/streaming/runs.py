"""Incremental runs: everything new since the last run, then stop."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery


def start_available_now(stream: DataFrame, path: str, checkpoint: str, fmt: str = "parquet") -> StreamingQuery:
    """Append what is available to a file sink; the checkpoint makes each input row count once."""
    writer = stream.writeStream.format(fmt).option("checkpointLocation", checkpoint)
    return writer.outputMode("append").trigger(availableNow=True).start(path)


def run_available_now(stream: DataFrame, path: str, checkpoint: str, fmt: str = "parquet") -> None:
    """Run to the end and raise if the stream failed."""
    start_available_now(stream, path, checkpoint, fmt).awaitTermination()


def start_kafka_sink(stream: DataFrame, servers: str, topic: str, checkpoint: str) -> StreamingQuery:
    """Send `value` texts to a topic; needs the Kafka connector on the class path."""
    writer = stream.writeStream.format("kafka").option("kafka.bootstrap.servers", servers).option("topic", topic)
    return writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
