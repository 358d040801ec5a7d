import datetime

import pytest
from pyspark.sql import functions as F

from tripflow.functions import elapsed_minutes, elapsed_whole_minutes, guarded_ratio, split_part_at
from tripflow.medallion import gold, silver
from tripflow.operators import quality_gate


def ts(text):
    return datetime.datetime.fromisoformat(text)


MODERN = {
    "VendorID": "bigint", "tpep_pickup_datetime": "timestamp_ntz", "tpep_dropoff_datetime": "timestamp_ntz",
    "passenger_count": "double", "trip_distance": "double", "payment_type": "bigint", "fare_amount": "double",
    "tip_amount": "double", "tolls_amount": "double", "total_amount": "double", "mta_tax": "double", "extra": "double",
    "RatecodeID": "double", "store_and_fwd_flag": "string",
}
GOOD = {
    "VendorID": 1, "tpep_pickup_datetime": ts("2025-03-01 08:00:00"), "tpep_dropoff_datetime": ts("2025-03-01 08:30:00"),
    "passenger_count": 2.0, "trip_distance": 5.0, "payment_type": 1, "fare_amount": 20.0, "tip_amount": 5.0,
    "tolls_amount": 1.0, "total_amount": 27.0, "mta_tax": 0.5, "extra": None, "RatecodeID": 1.0, "store_and_fwd_flag": "N",
}


def modern(spark, *changes):
    ddl = ", ".join(f"{n} {t}" for n, t in MODERN.items())
    return spark.createDataFrame([tuple({**GOOD, **c}.values()) for c in changes], ddl)


def test_yellow_gate(spark):
    raw = modern(
        spark, {},
        {"tolls_amount": None}, {"tip_amount": None}, {"fare_amount": -0.01}, {"trip_distance": None},
        {"tpep_pickup_datetime": None}, {"tpep_dropoff_datetime": ts("2025-03-01 08:00:00")},
        {"tpep_dropoff_datetime": ts("2025-03-01 07:00:00")},
        {"mta_tax": None}, {"fare_amount": 0.0}, {"trip_distance": 0.0, "passenger_count": 0.0},
    )
    trips = silver.yellow({"modern": raw})
    assert trips.count() == 4
    assert len(trips.columns) == 19
    row = trips.first()
    assert (row.vendor_id, row.passenger_count, row.surcharge, row.pickup_longitude) == ("1", 2, 0.0, None)
    assert row.trip_duration_minutes == 30.0


def test_legacy_text_times_and_drifted_text(spark):
    ddl = """vendor_name string, Trip_Pickup_DateTime string, Trip_Dropoff_DateTime string, Passenger_Count string,
        Trip_Distance double, Start_Lon double, Start_Lat double, Rate_Code double, store_and_forward double,
        End_Lon double, End_Lat double, Payment_Type string, Fare_Amt double, surcharge double, mta_tax double,
        Tip_Amt double, Tolls_Amt double, Total_Amt double"""
    row = ["CMT", "2009-01-04 02:52:00", "2009-01-04 03:02:00", "1.0", 2.6, -73.9, 40.7, None, None, -73.9, 40.8, "CRD",
           8.9, None, None, 0.0, 0.0, 9.4]
    bad = [*row[:1], "no time", *row[2:]]
    unread = [*row[:3], "two", *row[4:]]
    got = silver.yellow({"legacy": spark.createDataFrame([row, bad, unread], ddl)}).orderBy("passenger_count").collect()
    assert [(r.passenger_count, r.trip_duration_minutes, r.surcharge) for r in got] == [(None, 10.0, 0.0), (1, 10.0, 0.0)]


def test_missing_raw_column_is_an_error(spark):
    with pytest.raises(Exception, match="UNRESOLVED_COLUMN"):
        silver.yellow({"modern": modern(spark, {}).drop("extra")})


def test_single_dataset_drops_copies_and_empty_rows(spark):
    raw = modern(spark, {"extra": 1.0}, {"extra": 1.0}, {"extra": 2.0}).withColumns(
        {"improvement_surcharge": F.lit(0.3), "PULocationID": F.lit(1), "DOLocationID": F.lit(7)}
    )
    empty = raw.limit(1).select(*(F.lit(None).cast(f.dataType).alias(f.name) for f in raw.schema.fields))
    zones = spark.createDataFrame([(1, "Queens", "Astoria", "Boro Zone")], "LocationID int, Borough string, Zone string, service_zone string")
    got = silver.single_dataset(raw.union(empty), zones)
    assert got.count() == 2
    assert {(r.PUZone, r.DOZone) for r in got.collect()} == {("Astoria", None)}


def test_gate_without_rules_keeps_all(spark):
    assert quality_gate(spark.range(3)).count() == 3


def test_durations(spark):
    start = "2025-01-01 00:00:30"
    ends = ["2025-01-01 00:00:30", "2025-01-01 00:00:00", "2025-01-01 00:01:29", "2025-01-01 00:01:50", "2025-01-01 00:02:10.9"]
    df = spark.createDataFrame([(i, ts(start), ts(e)) for i, e in enumerate(ends)], "i int, a timestamp_ntz, b timestamp_ntz")
    got = df.select("i", elapsed_minutes("a", "b").alias("m"), elapsed_whole_minutes("a", "b").alias("w")).orderBy("i").collect()
    assert [r.m for r in got] == [0.0, -0.5, 59 / 60, 80 / 60, 100 / 60]
    assert [r.w for r in got] == [0, 0, 0, 1, 1]


def test_split_part_and_ratio(spark):
    df = spark.createDataFrame([("aXXb", 1.0, 0.0), ("a", 1.0, -2.0), (None, 3.0, 2.0), ("a", 1.0, None)], "s string, n double, d double")
    got = df.select(split_part_at("s", "XX", 1).alias("p"), guarded_ratio(F.col("n"), F.col("d")).alias("r")).collect()
    assert [tuple(r) for r in got] == [("b", 0.0), (None, 0.0), (None, 1.5), (None, 0.0)]


def silver_rows(spark, *changes):
    return silver.yellow({"modern": modern(spark, *changes)})


def test_gold_edges(spark):
    trips = silver_rows(spark, {}, {"fare_amount": 0.0, "passenger_count": None, "mta_tax": None, "trip_distance": 0.0})
    tips = {r.fare_amount: r for r in gold.tips_with_extremes(trips).collect()}
    assert (tips[20.0].tip_ratio, tips[20.0].is_tipped, tips[20.0].is_extreme_tip) == (0.25, True, False)
    assert (tips[0.0].tip_ratio, tips[0.0].is_extreme_tip) == (0.0, False)
    money = {r.total_fees: r for r in gold.financials(trips).collect()}
    assert (money[1.5].cost_per_mile, money[1.5].fare_per_passenger) == (5.4, 13.5)
    assert (money[None].cost_per_mile, money[None].fare_per_passenger) == (0.0, 0.0)
    speed = {r.trip_distance: r for r in gold.performance(trips).collect()}
    assert (speed[5.0].avg_speed_mph, speed[5.0].revenue_per_minute) == (10.0, 0.9)
    flags = sorted((r.trip_type, r.is_suspicious) for r in gold.classifications(trips).collect())
    assert flags == [("medium", False), ("short", True)]


@pytest.mark.parametrize("hour, peak", [(6, False), (7, True), (9, True), (10, False), (15, False), (16, True), (19, True), (20, False)])
def test_peak_hours(spark, hour, peak):
    start = ts(f"2025-03-03 {hour:02d}:59:59")
    trips = silver_rows(spark, {"tpep_pickup_datetime": start, "tpep_dropoff_datetime": start + datetime.timedelta(minutes=5)})
    row = gold.classifications(trips).first()
    assert (row.is_peak_hour, row.is_weekend) == (peak, False)


def test_weekend_distance_and_card(spark):
    start = {d: {"tpep_pickup_datetime": ts(f"2025-03-0{d} 12:00:00"), "tpep_dropoff_datetime": ts(f"2025-03-0{d} 13:00:00")} for d in (1, 2, 3)}
    assert [gold.classifications(silver_rows(spark, s)).first().is_weekend for s in start.values()] == [True, True, False]
    lengths = silver_rows(spark, *({"trip_distance": d} for d in (1.99, 2.0, 9.99, 10.0)))
    assert [r.trip_type for r in gold.classifications(lengths).collect()] == ["short", "medium", "medium", "long"]
    cards = silver_rows(spark, {"payment_type": 1}, {"payment_type": 2}, {"payment_type": None})
    assert [r.is_card_payment for r in gold.classifications(cards).collect()] == [True, False, None]


def test_fhv_summary_counts_flags(spark):
    raw = spark.createDataFrame(
        [("B1", ts("2025-01-01 00:00:00"), ts("2025-01-01 00:10:30"), 1, 2, "1", "B1"),
         ("B1", ts("2025-01-01 00:00:00"), ts("2025-01-01 00:05:00"), None, 2, None, "B1"),
         ("B2", ts("2025-01-01 00:00:00"), None, None, 2, "1", "B1")],
        "dispatching_base_num string, pickup_datetime timestamp_ntz, dropOff_datetime timestamp_ntz, PUlocationID int, "
        "DOlocationID int, SR_Flag string, Affiliated_base_number string",
    )
    assert [tuple(r) for r in gold.fhv_summary(silver.fhv(raw)).collect()] == [("B1", 2, 15.5, 1)]
