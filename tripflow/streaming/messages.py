"""JSON messages: the same frame-to-frame functions serve batches and streams."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tripflow.functions.expressions import split_part_at

# Shape of a student message and the mark between first and last name.
STUDENT_SCHEMA = "student_name string, graduation_year string, major string"
NAME_MARK = "XX"

# Text format of the event times, the longest trip and the names of the time columns.
EVENT_TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"
MAX_EVENT_MINUTES = 60
PICKUP, DROPOFF = "tpep_pickup_datetime", "tpep_dropoff_datetime"


def parse_messages(df: DataFrame, schema: str | StructType, carrier: str = "value") -> DataFrame:
    """Lift the fields of a JSON carrier into columns and drop the carrier.

    Malformed messages give null fields.
    """
    others = [c for c in df.columns if c != carrier]
    parsed = df.select(*others, F.from_json(F.col(carrier).cast("string"), schema).alias("__message"))
    return parsed.select(*others, "__message.*")


def normalize_names(df: DataFrame, schema: str | StructType = STUDENT_SCHEMA) -> DataFrame:
    """Student messages with the joined name split into first_name and last_name."""
    return (
        parse_messages(df, schema)
        .withColumns(
            {
                "first_name": split_part_at("student_name", NAME_MARK, 0),
                "last_name": split_part_at("student_name", NAME_MARK, 1),
            }
        )
        .drop("student_name")
    )


def to_trip_events(
    trips: DataFrame,
    clock: Column | None = None,
    minutes: Column | None = None,
    fraction: float | None = None,
    seed: int = 42,
) -> DataFrame:
    """Trips as live events: one JSON text per row in `value`, ready for a Kafka sink.

    The trip ends at `clock` (now) and began `minutes` earlier (a seeded random
    whole number from 0 to 60). With `fraction`, a seeded sample of the rows.
    """
    clock = F.current_timestamp() if clock is None else clock
    minutes = F.floor(F.rand(seed) * (MAX_EVENT_MINUTES + 1)) if minutes is None else minutes
    picked = trips if fraction is None else trips.sample(fraction=fraction, seed=seed)
    start = F.timestamp_add("MINUTE", -minutes, clock)
    timed = picked.withColumns(
        {PICKUP: F.date_format(start, EVENT_TIME_FORMAT), DROPOFF: F.date_format(clock, EVENT_TIME_FORMAT)}
    )
    return timed.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("value"))


def parse_trip_events(df: DataFrame, schema: str | StructType) -> DataFrame:
    """Trip events as typed rows; times that cannot be read become null."""
    rows = parse_messages(df, schema)
    return rows.withColumns({c: F.try_to_timestamp(F.col(c), F.lit(EVENT_TIME_FORMAT)) for c in (PICKUP, DROPOFF)})
