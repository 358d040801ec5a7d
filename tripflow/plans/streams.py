"""Messages and incremental streams, driven from files."""

from __future__ import annotations

from pyspark.sql import functions as F

from tripflow.plans import trips
from tripflow.plans.base import query, table
from tripflow.session import scratch_path
from tripflow.sources import read_stream_folder, save
from tripflow.streaming.messages import STUDENT_SCHEMA, normalize_names, parse_trip_events, to_trip_events
from tripflow.streaming.runs import run_available_now

NAMES_SQL = """SELECT c_mktsegment AS major, CAST(c_nationkey AS VARCHAR) AS graduation_year,
                      c_name AS first_name, CASE WHEN c_nationkey <> 0 THEN CAST(c_custkey AS VARCHAR) END AS last_name
               FROM customer"""


def student_messages(spark, sf):
    """Customers as student messages; those of nation 0 have no name mark."""
    name = F.when(F.col("c_nationkey") != 0, F.concat_ws("XX", "c_name", "c_custkey")).otherwise(F.col("c_name"))
    message = F.struct(
        name.alias("student_name"),
        F.col("c_nationkey").cast("string").alias("graduation_year"),
        F.col("c_mktsegment").alias("major"),
    )
    return table(spark, sf, "customer").select(F.to_json(message).cast("binary").alias("value"))


@query("normalize_names", NAMES_SQL)
def names_batch(spark, sf):
    return normalize_names(student_messages(spark, sf))


@query("stream_normalize_names", NAMES_SQL)
def names_stream(spark, sf):
    """Two runs on one checkpoint: the second finds nothing new."""
    inbox, outbox, checkpoint = (scratch_path(spark, n) for n in ("inbox", "students", "checkpoint"))
    save(student_messages(spark, sf), inbox)
    for _ in range(2):
        messages = read_stream_folder(spark, inbox, "value binary")
        run_available_now(messages.transform(normalize_names, STUDENT_SCHEMA), outbox, checkpoint)
    return spark.read.parquet(outbox)


CLOCK = "2025-06-01 12:30:15"
EVENT_SCHEMA = """VendorID bigint, tpep_pickup_datetime string, tpep_dropoff_datetime string, passenger_count int,
    trip_distance double, payment_type int, store_and_fwd_flag string"""
EVENT_COLUMNS = ["VendorID", "passenger_count", "trip_distance", "payment_type", "store_and_fwd_flag"]
EVENT_MINUTES = "PULocationID"


def trip_events(spark, sf):
    """Every trip as a live event that ends at a fixed time and took as many minutes as its zone's number."""
    raw = trips.raw_modern(spark, sf).select(*EVENT_COLUMNS, EVENT_MINUTES)
    clock = F.lit(CLOCK).cast("timestamp_ntz")
    return to_trip_events(raw, clock, F.col(EVENT_MINUTES))


_EVENT_START = f"TIMESTAMP '{CLOCK}' - to_minutes(pu)"


@query(
    "trip_events_json",
    f"""SELECT concat('{{"VendorID":', vendor, ',"passenger_count":', coalesce(CAST(passengers AS VARCHAR), 'null'),
                      ',"trip_distance":', distance, ',"payment_type":', payment,
                      ',"store_and_fwd_flag":"', stored, '","PULocationID":', pu,
                      ',"tpep_pickup_datetime":"', strftime({_EVENT_START}, '%Y-%m-%d %H:%M:%S'),
                      '","tpep_dropoff_datetime":"{CLOCK}"}}') AS value
        FROM ({trips.TRIPS_SQL})""",
)
def trip_events_json(spark, sf):
    return trip_events(spark, sf)


@query(
    "stream_trip_events",
    f"""SELECT vendor AS VendorID, {_EVENT_START} AS tpep_pickup_datetime, TIMESTAMP '{CLOCK}' AS tpep_dropoff_datetime,
               CAST(passengers AS INTEGER) AS passenger_count, distance AS trip_distance,
               CAST(payment AS INTEGER) AS payment_type, stored AS store_and_fwd_flag
        FROM ({trips.TRIPS_SQL})""",
)
def stream_trip_events(spark, sf):
    """Events to typed bronze rows."""
    inbox, outbox, checkpoint = (scratch_path(spark, n) for n in ("inbox", "events", "checkpoint"))
    save(trip_events(spark, sf), inbox)
    messages = read_stream_folder(spark, inbox, "value string")
    run_available_now(parse_trip_events(messages, EVENT_SCHEMA), outbox, checkpoint)
    times = {c: F.col(c).cast("timestamp_ntz") for c in ("tpep_pickup_datetime", "tpep_dropoff_datetime")}
    return spark.read.parquet(outbox).withColumns(times)
