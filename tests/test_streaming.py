import datetime
import json

from pyspark.sql import functions as F

from tripflow.sources import read_stream_folder, save
from tripflow.streaming.messages import normalize_names, parse_trip_events, to_trip_events
from tripflow.streaming.runs import run_available_now


def message(name, year="2023", major="math"):
    return json.dumps({"student_name": name, "graduation_year": year, "major": major})


def test_normalize_names(spark):
    texts = [message("mayaXXlindqvist"), message("single"), "{not json", message("aXXbXXc")]
    df = spark.createDataFrame([(t.encode(), i) for i, t in enumerate(texts)], "value binary, offset int")
    got = normalize_names(df)
    assert got.columns == ["offset", "graduation_year", "major", "first_name", "last_name"]
    assert [(r.first_name, r.last_name) for r in got.orderBy("offset").collect()] == [
        ("maya", "lindqvist"), ("single", None), (None, None), ("a", "b"),
    ]


def test_available_now_counts_each_row_once(spark, tmp_path):
    inbox, outbox, checkpoint = (str(tmp_path / n) for n in ("in", "out", "check"))

    def run():
        run_available_now(read_stream_folder(spark, inbox, "value string", max_files=1).transform(normalize_names), outbox, checkpoint)
        return sorted(r.first_name for r in spark.read.parquet(outbox).collect())

    save(spark.createDataFrame([(message("aXXb"),), (message("cXXd"),)], "value string"), inbox)
    assert run() == ["a", "c"]
    assert run() == ["a", "c"]
    save(spark.createDataFrame([(message("eXXf"),)], "value string"), inbox, mode="append")
    assert run() == ["a", "c", "e"]


def test_trip_events(spark):
    trips = spark.createDataFrame([(1, 2.5), (2, None)], "VendorID int, trip_distance double")
    clock = F.lit("2025-06-01 12:00:00").cast("timestamp_ntz")
    events = to_trip_events(trips, clock).collect()
    assert [e.value for e in to_trip_events(trips, clock).collect()] == [e.value for e in events]
    for event, trip in zip(events, trips.collect()):
        row = json.loads(event.value)
        assert (row["VendorID"], row["trip_distance"]) == tuple(trip)
        assert row["tpep_dropoff_datetime"] == "2025-06-01 12:00:00"
        start = datetime.datetime.fromisoformat(row["tpep_pickup_datetime"])
        assert 0 <= (datetime.datetime(2025, 6, 1, 12) - start).seconds // 60 <= 60
    assert to_trip_events(spark.range(1000), clock, fraction=0.1).count() < 200


def test_live_clock_and_replaced_times(spark):
    trips = spark.createDataFrame([("old", 7)], "tpep_pickup_datetime string, VendorID int")
    row = json.loads(to_trip_events(trips).first().value)
    assert list(row) == ["tpep_pickup_datetime", "VendorID", "tpep_dropoff_datetime"]
    assert row["tpep_pickup_datetime"] <= row["tpep_dropoff_datetime"]


def test_unreadable_event_times(spark):
    df = spark.createDataFrame([('{"VendorID": 1, "tpep_pickup_datetime": "soon", "tpep_dropoff_datetime": "2025-06-01 12:00:00"}',)], "value string")
    row = parse_trip_events(df, "VendorID int, tpep_pickup_datetime string, tpep_dropoff_datetime string").first()
    assert row.tpep_pickup_datetime is None
    assert row.tpep_dropoff_datetime == datetime.datetime(2025, 6, 1, 12)
