"""Trip data derived from `lineitem`: one trip per line, in the raw layouts of the trip files.

Values are made missing, negative or out of order for part of the lines, so that
every rule of the clean layer has something to do.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripflow.plans.base import table

# The same text serves Spark and the SQL oracle.
TRIP_EXPRESSIONS = {
    "vendor": "l_suppkey % 3",
    "payment": "l_linenumber % 5",
    "passengers": "nullif(l_linenumber - 1, 6)",
    "distance": "(l_quantity - 1) / 4e0",
    "fare": "l_extendedprice / 1e3 - 3e0",
    "tip": "(l_extendedprice / 1e3 - 3e0) * nullif(l_discount, 1e-1)",
    "tolls": "nullif(l_tax, 8e-2) * 1e1",
    "total": "(l_extendedprice / 1e3 - 3e0) * (l_discount + 1e0) + 1e0",
    "mta": "CASE WHEN l_linenumber = 4 THEN NULL ELSE 5e-1 END",
    "extra": "nullif(l_tax, 3e-2)",
    "improvement": "nullif(l_discount, 4e-2)",
    "congestion": "l_discount * 2e0",
    "airport": "l_tax * 3e0",
    "cbd": "CASE WHEN l_linenumber = 5 THEN NULL ELSE l_tax END",
    "rate": "l_linenumber",
    "stored": "CASE WHEN l_linestatus = 'O' THEN 'Y' ELSE 'N' END",
    "pu": "l_suppkey % 28",
    "do": "l_partkey % 28",
    "kind": "l_linenumber % 2 + 1",
    "base": "concat('B', lpad(CAST(l_suppkey % 40 AS STRING), 5, '0'))",
    "licence": "concat('HV', lpad(CAST(l_suppkey % 5 AS STRING), 4, '0'))",
    "shared": "CASE WHEN l_returnflag = 'R' THEN '1' ELSE NULL END",
    "longitude": "l_discount - 74e0",
    "latitude": "l_tax + 4e1",
    "seconds": "l_partkey % 95 * 60 - 240",
}
PICKUP_MINUTE = "l_orderkey * 7 % 1440"
LENGTH_SECONDS = "(l_partkey % 95 - 4) * 60 + l_suppkey % 60"

# Fixed bounds between the periods that the three yellow families cover.
LEGACY_UNTIL = "1997-01-01"
INTERMEDIATE_UNTIL = "1999-01-01"


def trip_source(spark: SparkSession, sf: str) -> DataFrame:
    # Plain second arithmetic: these expressions end up in filters and projections alike.
    begin = f"unix_timestamp(CAST(l_shipdate AS TIMESTAMP)) + {PICKUP_MINUTE} * 60"
    picked, dropped = f"timestamp_seconds({begin})", f"timestamp_seconds({begin} + {LENGTH_SECONDS})"
    return table(spark, sf, "lineitem").selectExpr(
        "l_shipdate AS day", f"{picked} AS pickup", f"{dropped} AS dropoff",
        *(f"{sql} AS {name}" for name, sql in TRIP_EXPRESSIONS.items()),
    )


TRIPS_SQL = (
    "SELECT l_shipdate AS day, "
    f"l_shipdate + to_minutes(CAST({PICKUP_MINUTE} AS BIGINT)) AS pickup, "
    f"l_shipdate + to_minutes(CAST({PICKUP_MINUTE} AS BIGINT)) + to_seconds(CAST({LENGTH_SECONDS} AS BIGINT)) AS dropoff, "
    + ", ".join(f'{sql} AS "{name}"' for name, sql in TRIP_EXPRESSIONS.items())
    + " FROM lineitem"
)


def _renamed(df: DataFrame, names: dict[str, str]) -> DataFrame:
    return df.select(*(F.expr(sql).alias(raw) for raw, sql in names.items()))


def raw_modern(spark: SparkSession, sf: str) -> DataFrame:
    """The newest yellow layout, with location ids and the later fees."""
    return modern_layout(trip_source(spark, sf))


def modern_layout(trips: DataFrame) -> DataFrame:
    return _renamed(
        trips,
        {
            "VendorID": "vendor",
            "tpep_pickup_datetime": "pickup",
            "tpep_dropoff_datetime": "dropoff",
            "passenger_count": "passengers",
            "trip_distance": "distance",
            "RatecodeID": "rate",
            "store_and_fwd_flag": "stored",
            "PULocationID": "pu",
            "DOLocationID": "do",
            "payment_type": "payment",
            "fare_amount": "fare",
            "extra": "extra",
            "mta_tax": "mta",
            "tip_amount": "tip",
            "tolls_amount": "tolls",
            "improvement_surcharge": "improvement",
            "total_amount": "total",
            "congestion_surcharge": "congestion",
            "Airport_fee": "airport",
            "cbd_congestion_fee": "cbd",
        },
    )


def legacy_layout(trips: DataFrame) -> DataFrame:
    """The oldest yellow layout: names of its own, times as text, payment in words."""
    return _renamed(
        trips,
        {
            "vendor_name": "concat('V', vendor)",
            "Trip_Pickup_DateTime": "date_format(pickup, 'yyyy-MM-dd HH:mm:ss')",
            "Trip_Dropoff_DateTime": "date_format(dropoff, 'yyyy-MM-dd HH:mm:ss')",
            "Passenger_Count": "CAST(passengers AS BIGINT)",
            "Trip_Distance": "distance",
            "Start_Lon": "longitude",
            "Start_Lat": "latitude",
            "Rate_Code": "CAST(NULL AS DOUBLE)",
            "store_and_forward": "CAST(NULL AS DOUBLE)",
            "End_Lon": "longitude",
            "End_Lat": "latitude",
            "Payment_Type": "CASE WHEN payment = 1 THEN 'CRD' WHEN payment = 2 THEN 'CRE' ELSE 'CSH' END",
            "Fare_Amt": "fare",
            "surcharge": "extra",
            "mta_tax": "mta",
            "Tip_Amt": "tip",
            "Tolls_Amt": "tolls",
            "Total_Amt": "total",
        },
    )


def intermediate_layout(trips: DataFrame) -> DataFrame:
    return _renamed(
        trips,
        {
            "vendor_id": "concat('V', vendor)",
            "pickup_datetime": "date_format(pickup, 'yyyy-MM-dd HH:mm:ss')",
            "dropoff_datetime": "date_format(dropoff, 'yyyy-MM-dd HH:mm:ss')",
            "passenger_count": "CAST(passengers AS BIGINT)",
            "trip_distance": "distance",
            "pickup_longitude": "longitude",
            "pickup_latitude": "latitude",
            "rate_code": "rate",
            "store_and_fwd_flag": "stored",
            "dropoff_longitude": "longitude",
            "dropoff_latitude": "latitude",
            "payment_type": "CASE WHEN payment = 1 THEN 'CRD' WHEN payment = 2 THEN 'CRE' ELSE 'CSH' END",
            "fare_amount": "fare",
            "surcharge": "extra",
            "mta_tax": "mta",
            "tip_amount": "tip",
            "tolls_amount": "tolls",
            "total_amount": "total",
        },
    )


def raw_families(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    """All trips, each in the family of its period."""
    trips, day = trip_source(spark, sf), F.col("day")
    legacy, intermediate = (F.lit(d).cast("timestamp_ntz") for d in (LEGACY_UNTIL, INTERMEDIATE_UNTIL))
    return {
        "legacy": legacy_layout(trips.filter(day < legacy)),
        "intermediate": intermediate_layout(trips.filter((day >= legacy) & (day < intermediate))),
        "modern": modern_layout(trips.filter(day >= intermediate)),
    }


def raw_green(spark: SparkSession, sf: str) -> DataFrame:
    return _renamed(
        trip_source(spark, sf),
        {
            "VendorID": "vendor",
            "lpep_pickup_datetime": "pickup",
            "lpep_dropoff_datetime": "dropoff",
            "store_and_fwd_flag": "stored",
            "RatecodeID": "rate",
            "PULocationID": "pu",
            "DOLocationID": "do",
            "passenger_count": "passengers",
            "trip_distance": "distance",
            "fare_amount": "fare",
            "extra": "extra",
            "mta_tax": "mta",
            "tip_amount": "tip",
            "tolls_amount": "tolls",
            "improvement_surcharge": "improvement",
            "total_amount": "total",
            "payment_type": "payment",
            "trip_type": "kind",
        },
    )


def raw_fhv(spark: SparkSession, sf: str) -> DataFrame:
    return _renamed(
        trip_source(spark, sf),
        {
            "dispatching_base_num": "base",
            "pickup_datetime": "pickup",
            "dropOff_datetime": "dropoff",
            "PUlocationID": "pu",
            "DOlocationID": "do",
            "SR_Flag": "shared",
            "Affiliated_base_number": "base",
        },
    )


def raw_fhvhv(spark: SparkSession, sf: str) -> DataFrame:
    return _renamed(
        trip_source(spark, sf),
        {
            "hvfhs_license_num": "licence",
            "dispatching_base_num": "base",
            "originating_base_num": "base",
            "request_datetime": "timestampadd(MINUTE, -9, pickup)",
            "on_scene_datetime": "timestampadd(MINUTE, -2, pickup)",
            "pickup_datetime": "pickup",
            "dropoff_datetime": "dropoff",
            "PULocationID": "pu",
            "DOLocationID": "do",
            "trip_miles": "distance",
            "trip_time": "seconds",
            "base_passenger_fare": "fare",
            "tolls": "tolls",
            "bcf": "extra",
            "sales_tax": "improvement",
            "congestion_surcharge": "congestion",
            "airport_fee": "airport",
            "tips": "tip",
            "driver_pay": "total",
            "shared_request_flag": "stored",
            "shared_match_flag": "stored",
            "access_a_ride_flag": "stored",
            "wav_request_flag": "stored",
            "wav_match_flag": "stored",
        },
    )


# --- the same in SQL, as far as the oracles need it -------------------------

MINUTES_SQL = "(CAST(epoch(dropoff_datetime) AS BIGINT) - CAST(epoch(pickup_datetime) AS BIGINT)) / 60e0"
GATE_SQL = """tip_amount IS NOT NULL AND fare_amount >= 0 AND tip_amount >= 0 AND total_amount >= 0
              AND trip_distance >= 0 AND tolls_amount >= 0 AND dropoff_datetime > pickup_datetime"""


def _gated(select: str, gate: str = GATE_SQL) -> str:
    return f"SELECT *, {MINUTES_SQL} AS trip_duration_minutes FROM ({select} FROM ({TRIPS_SQL})) WHERE {gate}"


_METERED = """CAST(passengers AS INTEGER) AS passenger_count, distance AS trip_distance, fare AS fare_amount,
              tip AS tip_amount, tolls AS tolls_amount, total AS total_amount, mta AS mta_tax"""

YELLOW_MODERN_SQL = _gated(
    f"""SELECT CAST(vendor AS VARCHAR) AS vendor_id, pickup AS pickup_datetime, dropoff AS dropoff_datetime,
               {_METERED}, CAST(payment AS VARCHAR) AS payment_type, coalesce(extra, 0) AS surcharge,
               CAST(rate AS VARCHAR) AS rate_code, stored AS store_and_fwd_flag,
               CAST(NULL AS DOUBLE) AS pickup_longitude, CAST(NULL AS DOUBLE) AS pickup_latitude,
               CAST(NULL AS DOUBLE) AS dropoff_longitude, CAST(NULL AS DOUBLE) AS dropoff_latitude"""
)

_IS_MODERN = f"day >= TIMESTAMP '{INTERMEDIATE_UNTIL}'"
_IS_LEGACY = f"day < TIMESTAMP '{LEGACY_UNTIL}'"

YELLOW_FAMILIES_SQL = _gated(
    f"""SELECT CASE WHEN {_IS_MODERN} THEN CAST(vendor AS VARCHAR) ELSE concat('V', vendor) END AS vendor_id,
               pickup AS pickup_datetime, dropoff AS dropoff_datetime, {_METERED},
               CASE WHEN {_IS_MODERN} THEN CAST(payment AS VARCHAR) WHEN payment = 1 THEN 'CRD'
                    WHEN payment = 2 THEN 'CRE' ELSE 'CSH' END AS payment_type,
               coalesce(extra, 0) AS surcharge,
               CASE WHEN NOT {_IS_LEGACY} THEN CAST(rate AS VARCHAR) END AS rate_code,
               CASE WHEN NOT {_IS_LEGACY} THEN stored END AS store_and_fwd_flag,
               CASE WHEN NOT {_IS_MODERN} THEN longitude END AS pickup_longitude,
               CASE WHEN NOT {_IS_MODERN} THEN latitude END AS pickup_latitude,
               CASE WHEN NOT {_IS_MODERN} THEN longitude END AS dropoff_longitude,
               CASE WHEN NOT {_IS_MODERN} THEN latitude END AS dropoff_latitude"""
)

GREEN_SQL = _gated(
    f"""SELECT CAST(vendor AS VARCHAR) AS vendor_id, pickup AS pickup_datetime, dropoff AS dropoff_datetime,
               {_METERED}, CAST(payment AS VARCHAR) AS payment_type, coalesce(extra, 0) AS extra,
               coalesce(improvement, 0) AS improvement_surcharge, CAST(rate AS VARCHAR) AS rate_code,
               stored AS store_and_fwd_flag, CAST(pu AS INTEGER) AS pu_location_id,
               CAST("do" AS INTEGER) AS do_location_id, CAST(kind AS DOUBLE) AS trip_type_raw"""
)

FHV_SQL = _gated(
    """SELECT base AS dispatching_base_num, pickup AS pickup_datetime, dropoff AS dropoff_datetime,
              CAST(pu AS INTEGER) AS pu_location_id, CAST("do" AS INTEGER) AS do_location_id,
              shared AS sr_flag, base AS affiliated_base_number""",
    "dropoff_datetime > pickup_datetime",
)

FHVHV_SQL = _gated(
    """SELECT licence AS hvfhs_license_num, base AS dispatching_base_num, base AS originating_base_num,
              pickup - INTERVAL 9 MINUTE AS request_datetime, pickup - INTERVAL 2 MINUTE AS on_scene_datetime,
              pickup AS pickup_datetime, dropoff AS dropoff_datetime, CAST(pu AS INTEGER) AS pu_location_id,
              CAST("do" AS INTEGER) AS do_location_id, distance AS trip_miles, seconds AS trip_time_seconds,
              fare AS base_passenger_fare, tolls, extra AS bcf, improvement AS sales_tax,
              congestion AS congestion_surcharge, airport AS airport_fee, tip AS tips, total AS driver_pay,
              stored AS shared_request_flag, stored AS shared_match_flag, stored AS access_a_ride_flag,
              stored AS wav_request_flag, stored AS wav_match_flag""",
    "trip_miles >= 0 AND base_passenger_fare >= 0 AND dropoff_datetime > pickup_datetime",
)

SINGLE_SQL = f"""SELECT DISTINCT vendor AS VendorID, pickup AS tpep_pickup_datetime, dropoff AS tpep_dropoff_datetime,
       passengers AS passenger_count, distance AS trip_distance, rate AS RatecodeID, stored AS store_and_fwd_flag,
       pu AS PULocationID, "do" AS DOLocationID, payment AS payment_type, fare AS fare_amount, extra, mta AS mta_tax,
       tip AS tip_amount, tolls AS tolls_amount, improvement AS improvement_surcharge, total AS total_amount,
       congestion AS congestion_surcharge, airport AS Airport_fee, cbd AS cbd_congestion_fee,
       {MINUTES_SQL.replace("dropoff_datetime", "dropoff").replace("pickup_datetime", "pickup")} AS trip_duration_minutes
    FROM ({TRIPS_SQL})
    WHERE fare >= 0 AND tip >= 0 AND total >= 0 AND distance >= 0 AND tolls >= 0 AND extra >= 0 AND mta >= 0
      AND improvement >= 0 AND dropoff > pickup"""
