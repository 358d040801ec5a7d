"""Raw trip files to one clean layout per dataset.

A layout lists, per canonical column, the raw column, the type and the value
for a missing one. The layouts drive one `select`; Catalyst prunes the scan to
the raw columns named here.
"""

from __future__ import annotations

import functools
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripflow.functions.expressions import to_type
from tripflow.operators.joins import enrich_zones
from tripflow.operators.quality import quality_gate, with_positive_duration


@dataclass(frozen=True)
class Item:
    name: str
    source: str | None
    type: str = "double"
    missing: float | None = None


def project(raw: DataFrame, layout: Sequence[Item]) -> DataFrame:
    """Select a layout from a raw frame; a raw column that is absent is an error."""

    types = {f.name.lower(): f.dataType for f in raw.schema.fields}

    def column(item: Item) -> Column:
        if item.source is None:
            return F.lit(None).cast(item.type).alias(item.name)
        value, kind = F.col(item.source), types.get(item.source.lower())
        if item.missing is not None:  # only what is missing is filled; what can't be read stays unknown
            value = F.coalesce(value, F.lit(item.missing) if kind is None else F.lit(item.missing).cast(kind))
        if kind is not None:
            value = to_type(value, kind, item.type)
        return value.alias(item.name)

    return raw.select(*map(column, layout))


# Marker columns of the yellow schema families, first match wins.
YELLOW_FAMILIES = (("Trip_Pickup_DateTime", "legacy"), ("tpep_pickup_datetime", "modern"))
YELLOW_DEFAULT_FAMILY = "intermediate"

# Raw column names of the trip files and the canonical layout.
YELLOW_LAYOUTS = {
    "legacy": (
        Item("vendor_id", "vendor_name", "string"),
        Item("pickup_datetime", "Trip_Pickup_DateTime", "timestamp"),
        Item("dropoff_datetime", "Trip_Dropoff_DateTime", "timestamp"),
        Item("passenger_count", "Passenger_Count", "int"),
        Item("trip_distance", "Trip_Distance"),
        Item("payment_type", "Payment_Type", "string"),
        Item("fare_amount", "Fare_Amt"),
        Item("tip_amount", "Tip_Amt"),
        Item("tolls_amount", "Tolls_Amt"),
        Item("total_amount", "Total_Amt"),
        Item("mta_tax", "mta_tax"),
        Item("surcharge", "surcharge", missing=0.0),
        Item("rate_code", "Rate_Code", "string"),
        Item("store_and_fwd_flag", "store_and_forward", "string"),
        Item("pickup_longitude", "Start_Lon"),
        Item("pickup_latitude", "Start_Lat"),
        Item("dropoff_longitude", "End_Lon"),
        Item("dropoff_latitude", "End_Lat"),
    ),
    "modern": (
        Item("vendor_id", "VendorID", "string"),
        Item("pickup_datetime", "tpep_pickup_datetime", "timestamp"),
        Item("dropoff_datetime", "tpep_dropoff_datetime", "timestamp"),
        Item("passenger_count", "passenger_count", "int"),
        Item("trip_distance", "trip_distance"),
        Item("payment_type", "payment_type", "string"),
        Item("fare_amount", "fare_amount"),
        Item("tip_amount", "tip_amount"),
        Item("tolls_amount", "tolls_amount"),
        Item("total_amount", "total_amount"),
        Item("mta_tax", "mta_tax"),
        Item("surcharge", "extra", missing=0.0),
        Item("rate_code", "RatecodeID", "string"),
        Item("store_and_fwd_flag", "store_and_fwd_flag", "string"),
        Item("pickup_longitude", None),
        Item("pickup_latitude", None),
        Item("dropoff_longitude", None),
        Item("dropoff_latitude", None),
    ),
    "intermediate": (
        Item("vendor_id", "vendor_id", "string"),
        Item("pickup_datetime", "pickup_datetime", "timestamp"),
        Item("dropoff_datetime", "dropoff_datetime", "timestamp"),
        Item("passenger_count", "passenger_count", "int"),
        Item("trip_distance", "trip_distance"),
        Item("payment_type", "payment_type", "string"),
        Item("fare_amount", "fare_amount"),
        Item("tip_amount", "tip_amount"),
        Item("tolls_amount", "tolls_amount"),
        Item("total_amount", "total_amount"),
        Item("mta_tax", "mta_tax"),
        Item("surcharge", "surcharge", missing=0.0),
        Item("rate_code", "rate_code", "string"),
        Item("store_and_fwd_flag", "store_and_fwd_flag", "string"),
        Item("pickup_longitude", "pickup_longitude"),
        Item("pickup_latitude", "pickup_latitude"),
        Item("dropoff_longitude", "dropoff_longitude"),
        Item("dropoff_latitude", "dropoff_latitude"),
    ),
}

GREEN_LAYOUT = (
    Item("vendor_id", "VendorID", "string"),
    Item("pickup_datetime", "lpep_pickup_datetime", "timestamp"),
    Item("dropoff_datetime", "lpep_dropoff_datetime", "timestamp"),
    Item("passenger_count", "passenger_count", "int"),
    Item("trip_distance", "trip_distance"),
    Item("payment_type", "payment_type", "string"),
    Item("fare_amount", "fare_amount"),
    Item("tip_amount", "tip_amount"),
    Item("tolls_amount", "tolls_amount"),
    Item("total_amount", "total_amount"),
    Item("mta_tax", "mta_tax"),
    Item("extra", "extra", missing=0.0),
    Item("improvement_surcharge", "improvement_surcharge", missing=0.0),
    Item("rate_code", "RatecodeID", "string"),
    Item("store_and_fwd_flag", "store_and_fwd_flag", "string"),
    Item("pu_location_id", "PULocationID", "int"),
    Item("do_location_id", "DOLocationID", "int"),
    Item("trip_type_raw", "trip_type"),
)

FHV_LAYOUT = (
    Item("dispatching_base_num", "dispatching_base_num", "string"),
    Item("pickup_datetime", "pickup_datetime", "timestamp"),
    Item("dropoff_datetime", "dropOff_datetime", "timestamp"),
    Item("pu_location_id", "PUlocationID", "int"),
    Item("do_location_id", "DOlocationID", "int"),
    Item("sr_flag", "SR_Flag", "string"),
    Item("affiliated_base_number", "Affiliated_base_number", "string"),
)

FHVHV_LAYOUT = (
    Item("hvfhs_license_num", "hvfhs_license_num", "string"),
    Item("dispatching_base_num", "dispatching_base_num", "string"),
    Item("originating_base_num", "originating_base_num", "string"),
    Item("request_datetime", "request_datetime", "timestamp"),
    Item("on_scene_datetime", "on_scene_datetime", "timestamp"),
    Item("pickup_datetime", "pickup_datetime", "timestamp"),
    Item("dropoff_datetime", "dropoff_datetime", "timestamp"),
    Item("pu_location_id", "PULocationID", "int"),
    Item("do_location_id", "DOLocationID", "int"),
    Item("trip_miles", "trip_miles"),
    Item("trip_time_seconds", "trip_time", "bigint"),
    Item("base_passenger_fare", "base_passenger_fare"),
    Item("tolls", "tolls"),
    Item("bcf", "bcf"),
    Item("sales_tax", "sales_tax"),
    Item("congestion_surcharge", "congestion_surcharge"),
    Item("airport_fee", "airport_fee"),
    Item("tips", "tips"),
    Item("driver_pay", "driver_pay"),
    Item("shared_request_flag", "shared_request_flag", "string"),
    Item("shared_match_flag", "shared_match_flag", "string"),
    Item("access_a_ride_flag", "access_a_ride_flag", "string"),
    Item("wav_request_flag", "wav_request_flag", "string"),
    Item("wav_match_flag", "wav_match_flag", "string"),
)

# The columns each dataset's gate looks at.
TIMES = ("pickup_datetime", "dropoff_datetime")
METERED_NOT_NULL = (*TIMES, "trip_distance", "fare_amount", "tip_amount", "total_amount")
METERED_NON_NEGATIVE = ("fare_amount", "tip_amount", "total_amount", "trip_distance", "tolls_amount")
FHVHV_MEASURES = ("trip_miles", "base_passenger_fare")
SINGLE_NON_NEGATIVE = (
    "fare_amount", "tip_amount", "total_amount", "trip_distance", "tolls_amount", "extra", "mta_tax",
    "improvement_surcharge",
)
ZONE_ATTRIBUTES = ("Borough", "Zone", "service_zone")


def yellow(families: Mapping[str, DataFrame]) -> DataFrame:
    """Yellow trips from the families that are present, gated, with their duration."""
    parts = [project(families[name], layout) for name, layout in YELLOW_LAYOUTS.items() if name in families]
    trips = functools.reduce(DataFrame.unionByName, parts)
    return with_positive_duration(quality_gate(trips, METERED_NOT_NULL, METERED_NON_NEGATIVE), *TIMES)


def green(raw: DataFrame) -> DataFrame:
    trips = quality_gate(project(raw, GREEN_LAYOUT), METERED_NOT_NULL, METERED_NON_NEGATIVE)
    return with_positive_duration(trips, *TIMES)


def fhv(raw: DataFrame) -> DataFrame:
    return with_positive_duration(quality_gate(project(raw, FHV_LAYOUT), TIMES), *TIMES)


def fhvhv(raw: DataFrame) -> DataFrame:
    trips = quality_gate(project(raw, FHVHV_LAYOUT), (*TIMES, *FHVHV_MEASURES), FHVHV_MEASURES)
    return with_positive_duration(trips, *TIMES)


def with_trip_id(trips: DataFrame) -> DataFrame:
    """A random unique id per row, fixed once the table is written."""
    return trips.select(F.expr("uuid()").alias("trip_id"), "*")


def single_dataset(raw: DataFrame, zones: DataFrame) -> DataFrame:
    """One raw dataset kept in its own layout: deduplicated, gated, with both zones looked up.

    The gate and the duration look at one row each, so they run before the
    duplicates are removed and fewer rows reach that shuffle. A row without any
    value fails the gate, so it needs no test of its own.
    """
    times = ("tpep_pickup_datetime", "tpep_dropoff_datetime")
    good = with_positive_duration(quality_gate(raw, (), SINGLE_NON_NEGATIVE), *times)
    roles = {"PU": "PULocationID", "DO": "DOLocationID"}
    return enrich_zones(good.dropDuplicates(), zones, "LocationID", roles, ZONE_ATTRIBUTES)
