"""Metric tables over clean trips: narrow projections and grouped summaries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripflow.functions.expressions import fee_total, guarded_ratio

KEYS = ("vendor_id", "pickup_datetime")

# Fee columns and card payment codes per dataset.
YELLOW_FEES = ("surcharge", "mta_tax", "tolls_amount")
GREEN_FEES = ("extra", "mta_tax", "tolls_amount", "improvement_surcharge")
SINGLE_FEES = (
    "extra", "mta_tax", "tolls_amount", "improvement_surcharge", "congestion_surcharge", "Airport_fee",
    "cbd_congestion_fee",
)
YELLOW_CARD_CODES = ("CRD", "CRE", "1")
GREEN_CARD_CODES = ("1",)

# Peak hours (both ends included), weekend days (Sunday is 1), trip length classes.
MORNING_PEAK = (7, 9)
EVENING_PEAK = (16, 19)
WEEKEND_DAYS = (1, 7)
SHORT_BELOW = 2
MEDIUM_BELOW = 10


def tips(trips: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    ratio = guarded_ratio(F.col("tip_amount"), F.col("fare_amount"))
    return trips.select(
        *keys, "tip_amount", "fare_amount",
        F.round(ratio, 2).alias("tip_ratio"),
        (F.col("tip_amount") > 0).alias("is_tipped"),
    )


def tips_with_extremes(trips: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """Tips with a flag for tips above the fare, judged on the unrounded ratio."""
    ratio = guarded_ratio(F.col("tip_amount"), F.col("fare_amount"))
    return trips.select(
        *keys, "tip_amount", "fare_amount",
        F.round(ratio, 2).alias("tip_ratio"),
        (F.col("tip_amount") > 0).alias("is_tipped"),
        (ratio > 1).alias("is_extreme_tip"),
    )


def performance(trips: DataFrame, keys: Sequence[str] = KEYS, minutes: str = "trip_duration_minutes") -> DataFrame:
    spent = F.col(minutes)
    return trips.select(
        *keys, "trip_distance", minutes,
        F.round(guarded_ratio(F.col("trip_distance"), spent / 60.0), 2).alias("avg_speed_mph"),
        F.round(guarded_ratio(F.col("total_amount"), spent), 2).alias("revenue_per_minute"),
    )


def financials(trips: DataFrame, fees: Sequence[str] = YELLOW_FEES, keys: Sequence[str] = KEYS) -> DataFrame:
    total = F.col("total_amount")
    return trips.select(
        *keys,
        fee_total(fees).alias("total_fees"),
        "total_amount",
        F.round(guarded_ratio(total, F.col("trip_distance")), 2).alias("cost_per_mile"),
        F.round(guarded_ratio(total, F.col("passenger_count")), 2).alias("fare_per_passenger"),
    )


def classifications(
    trips: DataFrame,
    card_codes: Sequence[str] = YELLOW_CARD_CODES,
    keys: Sequence[str] = KEYS,
    pickup: str = "pickup_datetime",
) -> DataFrame:
    hour = F.hour(pickup)
    distance = F.col("trip_distance")
    return trips.select(
        *keys,
        (hour.between(*MORNING_PEAK) | hour.between(*EVENING_PEAK)).alias("is_peak_hour"),
        F.dayofweek(pickup).isin(*WEEKEND_DAYS).alias("is_weekend"),
        F.when(distance < SHORT_BELOW, "short")
        .when(distance < MEDIUM_BELOW, "medium")
        .otherwise("long")
        .alias("trip_type"),
        F.col("payment_type").isin(*card_codes).alias("is_card_payment"),
        ((distance <= 0) | (F.col("fare_amount") <= 0) | (F.col("trip_duration_minutes") <= 0)).alias("is_suspicious"),
    )


def fhv_summary(trips: DataFrame) -> DataFrame:
    """Trips, minutes and SR-flag trips per dispatching base."""
    return trips.groupBy("dispatching_base_num").agg(
        F.count("*").alias("trip_count"),
        F.round(F.sum("trip_duration_minutes"), 2).alias("total_trip_minutes"),
        F.count("sr_flag").alias("sr_flag_trip_count"),
    )


def fhvhv_summary(trips: DataFrame) -> DataFrame:
    """Trips, miles, fares, tips and driver pay per licence."""
    sums = {
        "total_trip_miles": "trip_miles",
        "total_base_passenger_fare": "base_passenger_fare",
        "total_tips": "tips",
        "total_driver_pay": "driver_pay",
    }
    return trips.groupBy("hvfhs_license_num").agg(
        F.count("*").alias("trip_count"), *(F.round(F.sum(c), 2).alias(name) for name, c in sums.items())
    )


# Published tables per clean table; those of single trips carry the given keys.
YELLOW_TABLES = {
    "yellow_taxi_tips": tips,
    "yellow_taxi_performance": performance,
    "yellow_taxi_financials": lambda trips, keys: financials(trips, YELLOW_FEES, keys),
    "yellow_taxi_classifications": lambda trips, keys: classifications(trips, YELLOW_CARD_CODES, keys),
}
GREEN_TABLES = {
    "green_taxi_tips": tips,
    "green_taxi_performance": performance,
    "green_taxi_financials": lambda trips, keys: financials(trips, GREEN_FEES, keys),
    "green_taxi_classifications": lambda trips, keys: classifications(trips, GREEN_CARD_CODES, keys),
}
SUMMARY_TABLES = {
    "fhv_trip": {"fhv_trip_summary": lambda trips, keys: fhv_summary(trips)},
    "fhvhv_trip": {"fhvhv_trip_summary": lambda trips, keys: fhvhv_summary(trips)},
}
