import pytest
from pyspark.sql.types import DecimalType, DoubleType, IntegerType, StringType, StructType

from tripflow.medallion.silver import YELLOW_DEFAULT_FAMILY, YELLOW_FAMILIES
from tripflow.operators import align_and_union, detect_family, read_drifting, read_families, unify_types


def schema(ddl):
    return StructType.fromDDL(ddl)


def test_families_follow_marker_columns():
    family = lambda cols: detect_family(cols, YELLOW_FAMILIES, YELLOW_DEFAULT_FAMILY)
    assert family(["Trip_Pickup_DateTime", "tpep_pickup_datetime"]) == "legacy"
    assert family(["tpep_pickup_datetime"]) == "modern"
    assert family(["pickup_datetime"]) == "intermediate"
    assert family(["trip_pickup_datetime"]) == "intermediate"


def test_unify_types(spark):
    types = unify_types([
        schema("a int, b int, c timestamp, d string, e decimal(10,2), Airport_fee int, f date"),
        schema("a int, b bigint, c timestamp_ntz, d int, e decimal(12,4), airport_fee double, f timestamp"),
    ])
    assert types["a"] == IntegerType()
    assert types["b"] == DoubleType()
    assert types["c"] == types["d"] == types["f"] == StringType()
    assert types["e"] == DecimalType(10, 2)
    assert types["airport_fee"] == DoubleType()


def test_text_absorbs_in_any_order(spark):
    parts = [schema("x int"), schema("x string"), schema("x double")]
    for order in ([0, 1, 2], [1, 2, 0], [2, 0, 1]):
        assert unify_types(parts[i] for i in order)["x"] == StringType()


def test_align_and_union(spark):
    a = spark.createDataFrame([(1, 1.5)], "id int, Airport_fee double")
    b = spark.createDataFrame([("x", 2)], "id string, airport_fee int")
    c = spark.createDataFrame([(3, "n")], "id bigint, note string")
    got = align_and_union([a, b, c])
    assert got.columns == ["id", "Airport_fee", "note"]
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(
        [("1", 1.5, None), ("x", 2.0, None), ("3", None, "n")], key=repr
    )


@pytest.fixture
def drifting(spark, tmp_path):
    frames = {
        "m1": spark.createDataFrame([(1, "2020-01-01")], "fee int, tpep_pickup_datetime string"),
        "m2": spark.createDataFrame([(2.5, "2020-01-02")], "fee double, tpep_pickup_datetime string"),
        "m3": spark.createDataFrame([(3, "2020-01-03")], "fee int, tpep_pickup_datetime string"),
        "old": spark.createDataFrame([("x",)], "Trip_Pickup_DateTime string"),
    }
    for name, df in frames.items():
        df.write.parquet(str(tmp_path / name))
    return {name: str(tmp_path / name) for name in frames}


def test_one_scan_per_schema(spark, drifting):
    got = read_drifting(spark, [drifting[n] for n in ("m1", "m2", "m3")])
    assert sorted(r.fee for r in got.collect()) == [1.0, 2.5, 3.0]
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 2


def test_read_families(spark, drifting):
    families = read_families(spark, list(drifting.values()), YELLOW_FAMILIES, YELLOW_DEFAULT_FAMILY)
    assert {name: df.count() for name, df in families.items()} == {"modern": 3, "legacy": 1}


def test_parts_of_one_folder_may_differ(spark, tmp_path):
    from tripflow.operators.drift import read_drifting

    path = str(tmp_path / "t.parquet")
    spark.range(2).selectExpr("id AS a").write.parquet(path)
    spark.range(2).selectExpr("id AS a", "'x' AS extra").write.mode("append").parquet(path)
    merged = read_drifting(spark, [path])
    assert sorted(merged.columns) == ["a", "extra"] and merged.count() == 4
    spark.range(2).selectExpr("CAST(id AS STRING) AS a").write.mode("append").parquet(path)
    clashing = read_drifting(spark, [path])
    assert dict(clashing.dtypes) == {"a": "string", "extra": "string"} and clashing.count() == 6


def test_jobs_follow_schemas_not_files(spark, tmp_path):
    import pyarrow as pa
    from pyarrow import parquet

    paths = []
    for i in range(1000):
        fee = pa.array([i], pa.int32()) if i % 2 else pa.array([i + 0.5], pa.float64())
        extra = {"note": pa.array(["n"])} if i % 2 else {}
        paths.append(str(tmp_path / f"trips {i:04d}.parquet"))
        parquet.write_table(pa.table({"id": pa.array([i], pa.int64()), "fee": fee, **extra}), paths[-1])
    jobs = spark.sparkContext.statusTracker().getJobIdsForGroup
    before = set(jobs(None))
    got = read_drifting(spark, paths)
    assert len(set(jobs(None)) - before) < 10
    assert dict(got.dtypes) == {"id": "bigint", "fee": "double", "note": "string"}
    row = got.selectExpr("count(*)", "sum(fee)", "count(note)", "count(DISTINCT id)").first()
    assert tuple(row) == (1000, sum(i if i % 2 else i + 0.5 for i in range(1000)), 500, 1000)


def test_many_folders_of_unlike_files(spark, tmp_path):
    paths = []
    for i in range(18):
        path = str(tmp_path / f"t{i}")
        spark.range(1).selectExpr(f"CAST({i} AS INT) AS a").coalesce(1).write.parquet(path)
        if i == 5:
            spark.range(1).selectExpr("'x' AS a").coalesce(1).write.mode("append").parquet(path)
        if i == 7:
            spark.range(1).selectExpr("1 AS a", "2 AS b").coalesce(1).write.mode("append").parquet(path)
        if i == 9:
            spark.range(1).selectExpr("1 AS a", "'p' AS k").write.mode("append").partitionBy("k").parquet(f"{path}p")
            paths.append(f"{path}p")
        paths.append(path)
    got = read_drifting(spark, paths)
    assert dict(got.dtypes) == {"a": "string", "b": "int", "k": "string"}
    assert got.count() == 21 and got.filter("a = 'x'").count() == 1 and got.filter("b = 2").count() == 1
    assert got.filter("k = 'p'").count() == 1


def test_file_systems_of_tasks():
    from tripflow.sources.footers import arrow_filesystem

    assert arrow_filesystem("file:/a/b c")[1] == arrow_filesystem("file:///a/b c")[1] == arrow_filesystem("/a/b c")[1] == "/a/b c"
    store = {"endpoint_override": "http://store:9000", "access_key": "k", "secret_key": "s", "region": "none"}
    system, place = arrow_filesystem("s3a://bucket/raw/x", store)
    assert system.type_name == "s3" and place == "bucket/raw/x"
    with pytest.raises(ValueError):
        arrow_filesystem("other://x/y")
