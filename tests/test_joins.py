import pytest
from pyspark.sql import functions as F

from tripflow.operators import attach_per_key, enrich_zones, is_small, outer_join


def rows_of(df):
    return sorted(map(repr, df.select(sorted(df.columns)).collect()))


@pytest.fixture(scope="module")
def hot(spark):
    rows = [("hot", i) for i in range(40)] + [(f"k{i % 9}", i) for i in range(40)] + [(None, i) for i in range(10)]
    return spark.createDataFrame(rows, "k string, i int")


@pytest.mark.parametrize("hot_rows", [5, 1000])
def test_attach_per_key_with_null_and_hot_keys(hot, hot_rows):
    per_key = hot.groupBy(F.col("k").alias("key")).agg(F.count("*").alias("n"), F.max("i").alias("top"))
    got = attach_per_key(hot, per_key, [("k", "key")], "n", 8, hot_rows).select("k", "i", "n", "top")
    expected = hot.join(per_key, F.col("k").eqNullSafe(F.col("key"))).select("k", "i", "n", "top")
    assert got.count() == 90
    assert rows_of(got) == rows_of(expected)


@pytest.mark.parametrize("how", ["left", "right"])
@pytest.mark.parametrize("hot_rows", [5, 1000])
def test_outer_join_with_hot_other_side(spark, hot, how, hot_rows):
    keys = spark.createDataFrame([("hot",), ("k1",), ("nobody",), (None,)], "key string")
    expected = keys.join(hot, F.col("key") == F.col("k"), "left")
    if how == "left":
        got = outer_join(keys, hot, [("key", "k")], "left", 8, hot_rows)
    else:
        got = outer_join(hot, keys, [("k", "key")], "right", 8, hot_rows)
    assert rows_of(got) == rows_of(expected)


def test_outer_join_refuses_other_kinds(hot):
    with pytest.raises(ValueError):
        outer_join(hot, hot, [("k", "k")], "full")


def test_is_small_stops_at_the_bound(spark):
    assert is_small(spark.range(10), 10)
    assert not is_small(spark.range(11), 10)
    assert not is_small(spark.range(10).withColumn("text", F.repeat(F.lit("x"), 100)), 10, 1_000)


def test_is_small_reads_no_further_than_the_bound(spark):
    late = spark.range(0, 1_000, 1, 100).select(F.when(F.col("id") < 500, F.col("id")).otherwise(F.raise_error(F.lit("read on"))).alias("id"))
    assert not is_small(late, 15)


def test_join_kinds_over_rides_and_depots(spark):
    rides = spark.createDataFrame([(k, None if k % 7 == 0 else k % 5) for k in range(20)], "ride int, depot_of int")
    depots = spark.createDataFrame([(d, f"depot {d}") for d in range(1, 8)], "depot int, name string")
    pairs, same = [("depot_of", "depot")], F.col("depot_of") == F.col("depot")
    unplaced = sorted(k for k in range(20) if k % 7 == 0 or k % 5 == 0)
    left, right = (outer_join(rides, depots, pairs, how) for how in ("left", "right"))
    assert rides.join(depots, same).count() == 20 - len(unplaced)
    assert sorted(r.ride for r in left.filter("name IS NULL").collect()) == unplaced
    assert sorted(r.depot for r in right.filter("ride IS NULL").collect()) == [5, 6, 7]
    assert sorted(r.ride for r in rides.join(depots, same, "left_anti").collect()) == unplaced


@pytest.mark.parametrize("max_rows", [1, 1000])
def test_enrich_zones(spark, max_rows):
    zones = spark.createDataFrame([(1, "Queens", "Astoria"), (2, "Bronx", "Belmont")], "LocationID int, Borough string, Zone string")
    trips = spark.createDataFrame([(10, 1, 2), (11, 2, 9), (12, None, 1)], "id int, pu int, do int")
    got = enrich_zones(trips, zones, "LocationID", {"PU": "pu", "DO": "do"}, ["Borough", "Zone"], max_rows)
    assert got.columns == ["id", "pu", "do", "PUBorough", "PUZone", "DOBorough", "DOZone"]
    assert sorted((r.id, r.PUZone, r.DOZone) for r in got.collect()) == [
        (10, "Astoria", "Belmont"), (11, "Belmont", None), (12, None, "Astoria"),
    ]
    # On its own the planner would broadcast this lookup too; the hint shows in the plan it starts from.
    plan = got._jdf.queryExecution().analyzed().toString()
    assert ("broadcast" in plan) == (max_rows == 1000)
