import pytest
from pyspark.sql import functions as F
from pyspark.errors import AnalysisException

from tripflow.session import (
    layer_catalog_conf,
    load_storage_conf,
    materialise,
    scale_conf,
    scratch_path,
    storage_conf_from_env,
    unique_name,
)
from tripflow.sources import (
    bronze_sample,
    discover_files,
    ensure_layer,
    ingest,
    publish_table,
    read_csv,
    read_json_lines,
    read_parquet,
    read_table,
    read_text_lines,
    register_view,
    save,
    table_exists,
)
from tripflow.operators import reused, word_counts
from tripflow.sources.files import list_paths
from tripflow.sources.streams import kafka_options


def test_save_modes(spark, tmp_path):
    path, df = str(tmp_path / "out"), spark.range(3)
    save(df, path)
    with pytest.raises(AnalysisException, match="PATH_ALREADY_EXISTS"):
        save(df, path)
    with pytest.raises(AnalysisException, match="PATH_ALREADY_EXISTS"):
        save(df, path, mode="error")
    save(df, path, mode="ignore")
    assert read_parquet(spark, path).count() == 3
    save(df, path, mode="append")
    assert read_parquet(spark, path).count() == 6
    save(df.limit(1), path, mode="overwrite")
    assert read_parquet(spark, path).count() == 1
    with pytest.raises(ValueError):
        save(df, path, mode="replace")


def test_csv_inferred_and_declared(spark, tmp_path):
    path = str(tmp_path / "csv")
    save(spark.createDataFrame([(1, "a", 1.5), (2, None, None)], "id int, s string, x double"), path, "csv", header=True)
    assert read_csv(spark, path).dtypes == [("id", "int"), ("s", "string"), ("x", "double")]
    assert read_csv(spark, path, "id STRING, s STRING, x STRING").dtypes == [("id", "string"), ("s", "string"), ("x", "string")]


def test_json_lines_and_multi_line(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"id": 1, "n": {"k": "v"}}\n{"id": 2}\n')
    (tmp_path / "b.txt").write_text('[{"id": 1},\n {"id": 2}]')
    assert read_json_lines(spark, str(tmp_path / "a.json")).count() == 2
    assert read_json_lines(spark, str(tmp_path / "b.txt"), "id INT", multi_line=True).count() == 2


def test_text_word_count(spark, tmp_path):
    (tmp_path / "t.txt").write_text("one two two\nthree two\n\n")
    counts = {r.word: r.n for r in word_counts(read_text_lines(spark, str(tmp_path / "t.txt"))).collect()}
    assert counts == {"one": 1, "two": 3, "three": 1, "": 1}


def test_discovery(spark, tmp_path):
    df = spark.range(2)
    for name in ("yellow_tripdata_2025-02.parquet", "yellow_tripdata_2025-01.parquet", "green_tripdata_1.parquet"):
        save(df, str(tmp_path / "raw" / name))
    raw = str(tmp_path / "raw")
    names = [p.rsplit("/", 1)[1] for p in list_paths(spark, raw, "yellow_tripdata_*.parquet")]
    assert names == ["yellow_tripdata_2025-01.parquet", "yellow_tripdata_2025-02.parquet"]
    assert read_parquet(spark, *list_paths(spark, raw, "yellow_*")).count() == 4
    assert list_paths(spark, raw, "fhv_*.parquet") == []
    assert list_paths(spark, str(tmp_path / "absent"), "*") == []
    assert discover_files(spark, raw + "/green_tripdata_1.parquet", "*.none").count() == 0
    found = discover_files(spark, raw + "/green_tripdata_1.parquet", "*.parquet").collect()
    assert found and all(r.length > 0 and r.modificationTime for r in found)


def test_listing_does_not_read_contents(spark, sf_dir):
    plan = discover_files(spark, sf_dir, "*.parquet")._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan


def test_bronze_sample(spark, tmp_path):
    for i in range(3):
        save(spark.range(20), str(tmp_path / "raw" / f"fhv_{i}.parquet"))
    frames = bronze_sample(spark, str(tmp_path / "raw"), {"fhv": "fhv_*.parquet", "none": "none_*"})
    assert [f.count() for f in frames["fhv"]] == [5, 5]
    assert frames["none"] == []


def test_tables(spark):
    layer = ensure_layer(spark, unique_name("layer"), scratch_path(spark, "layer"))
    name = f"{layer}.t"
    assert not table_exists(spark, name)
    publish_table(spark.range(3), name)
    publish_table(spark.range(2).withColumnRenamed("id", "other"), name)
    assert table_exists(spark, name)
    assert read_table(spark, name).columns == ["other"]
    assert ensure_layer(spark, layer) == layer
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    assert not table_exists(spark, name)


def test_view_is_replaced(spark):
    name = unique_name("v")
    register_view(spark.range(3), name)
    register_view(spark.range(1), name)
    assert spark.sql(f"SELECT * FROM {name}").count() == 1


def test_ingest(spark, tmp_path):
    save(spark.range(3), str(tmp_path / "a"))
    for _ in range(2):
        ingest(spark, str(tmp_path / "a"), str(tmp_path / "b"), "parquet")
    assert read_parquet(spark, str(tmp_path / "b")).count() == 3
    with pytest.raises(ValueError):
        ingest(spark, str(tmp_path / "a"), str(tmp_path / "c"), "orc")


def test_reused_is_released_after_an_error(spark):
    df = spark.range(5)
    with pytest.raises(RuntimeError):
        with reused(df) as shared:
            assert shared.is_cached
            raise RuntimeError
    assert not df.is_cached


def test_storage_settings(tmp_path):
    ini = tmp_path / "c.ini"
    ini.write_text("[minio]\nendpoint = https://store:9000\naccess_key = a\nsecret_key = b\n")
    conf = load_storage_conf(str(ini))
    assert conf["spark.hadoop.fs.s3a.endpoint"] == "https://store:9000"
    assert conf["spark.hadoop.fs.s3a.access.key"] == "a"
    assert conf["spark.hadoop.fs.s3a.path.style.access"] == "true"
    assert conf["spark.hadoop.fs.s3a.connection.ssl.enabled"] == "true"
    with pytest.raises(FileNotFoundError):
        load_storage_conf(str(tmp_path / "none.ini"))
    assert storage_conf_from_env({}) == {}
    env = storage_conf_from_env({"TRIPFLOW_S3_ENDPOINT": "http://store:9000"})
    assert env["spark.hadoop.fs.s3a.endpoint"] == "http://store:9000"
    assert "spark.hadoop.fs.s3a.secret.key" not in env


def test_layer_catalogs():
    conf = layer_catalog_conf({"silver_catalog": "s3a://silver"})
    assert conf["spark.sql.catalog.silver_catalog.warehouse"] == "s3a://silver"
    assert conf["spark.sql.catalog.silver_catalog.type"] == "hadoop"


def test_shuffle_partitions_grow_with_the_input():
    assert scale_conf(1 << 30)["spark.sql.shuffle.partitions"] == "200"
    assert scale_conf(100 << 40)["spark.sql.shuffle.partitions"] == "102400"


def test_kafka_options():
    assert kafka_options("h1:1,h2:2", "trips")["kafka.bootstrap.servers"] == "h1:1,h2:2"


def test_scratch_lies_in_the_shared_folder(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    first, second = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert first != second
    assert first.startswith(root) and second.startswith(root)
    assert materialise(spark.range(4)).inputFiles()[0].removeprefix("file://").startswith(root)


def test_entries_of_a_folder_whose_name_repeats(spark, tmp_path):
    from tripflow.sources.files import list_entries, list_paths

    folder = tmp_path / "raw" / "2024" / "raw"
    spark.range(3).write.parquet(str(folder / "yellow_tripdata_1.parquet"))
    assert [p.rsplit("/", 1)[-1] for p in list_entries(spark, str(folder))] == ["yellow_tripdata_1.parquet"]
    assert len(list_paths(spark, str(folder), "yellow_*")) == 1
    assert [p.rsplit("/", 1)[-1] for p in list_entries(spark, str(tmp_path / "raw"))] == ["2024"]


def test_a_name_is_never_missing(spark):
    import threading

    from tripflow.sources.sinks import publish_version

    name = f"{ensure_layer(spark, unique_name('versions'))}.t"
    publish_version(spark.range(1), name)
    seen, failed, stop = [], [], threading.Event()

    def read():
        while not stop.is_set():
            try:
                seen.append(spark.table(name).count())
            except Exception as error:  # noqa: BLE001
                failed.append(error)

    reader = threading.Thread(target=read)
    reader.start()
    for n in range(2, 6):
        assert publish_version(spark.range(n).withColumnRenamed("id", f"id{n}"), name).endswith(f"__v{n}")
    stop.set()
    reader.join()
    assert not failed and set(seen) <= {1, 2, 3, 4, 5} and seen == sorted(seen)
    assert spark.table(name).columns == ["id5"] and spark.table(name).count() == 5
    tables = {r.tableName for r in spark.sql(f"SHOW TABLES IN {name.split('.')[0]}").collect()}
    assert tables == {"t", "t__v4", "t__v5"}
    with pytest.raises(Exception, match="nothing_here"):
        publish_version(spark.range(3).selectExpr("raise_error('nothing_here') AS x"), name)
    assert spark.table(name).count() == 5


def test_rows_of_unlike_files(spark, tmp_path):
    import datetime

    from tripflow.sources.files import sample_cells, sample_rows

    raw = str(tmp_path / "raw")
    first = spark.createDataFrame([(i, datetime.datetime(2024, 1, i + 1)) for i in range(9)], "id int, at timestamp_ntz").coalesce(1)
    save(first, f"{raw}/a_1.parquet")
    save(spark.createDataFrame([("x", None, [1, 2])], "name string, `odd.name` double, xs array<int>"), f"{raw}/a_2.parquet")
    save(first.limit(0), f"{raw}/b_1.parquet")
    frames = bronze_sample(spark, raw, {"a": "a_*", "b": "b_*", "none": "c_*"}, rows=3)
    rows = sample_rows(spark, frames)
    got = {(r.dataset, r.file_no, r.position): r.schema for r in rows.collect()}
    assert sorted(got) == [("a", 1, 1), ("a", 1, 2), ("a", 1, 3), ("a", 2, 1)]
    assert got["a", 1, 1] == "id int, at timestamp_ntz" and got["a", 2, 1] == "name string, odd.name double, xs array<int>"
    cells = {tuple(r) for r in sample_cells(rows).collect()}
    assert {c for c in cells if c[1] == 2} == {("a", 2, 1, "name", "x"), ("a", 2, 1, "odd.name", None), ("a", 2, 1, "xs", "[1,2]")}
    assert ("a", 1, 2, "id", "1") in cells and ("a", 1, 3, "at", "2024-01-03 00:00:00") in cells
    typed = rows.filter("file_no = 1").selectExpr("variant_get(row, '$.at', 'timestamp_ntz') AS at").collect()
    assert typed[0].at.year == 2024


def test_rows_per_file(spark, tmp_path):
    from tripflow.sources.files import rows_per_file

    base = str(tmp_path / "tables")
    save(spark.range(10).repartition(3), f"{base}/many.parquet")
    save(spark.createDataFrame([("x",)], "other string").coalesce(1), f"{base}/one.parquet")
    save(spark.range(0).coalesce(1), f"{base}/empty.parquet")
    files = rows_per_file(spark, base)
    per_entry = files.groupBy("entry").agg(F.count("path").alias("n"), F.sum("rows").alias("rows")).collect()
    assert {r.entry: (r.n, r.rows) for r in per_entry} == {"many.parquet": (3, 10), "one.parquet": (1, 1), "empty.parquet": (1, 0)}
    assert "ReadSchema: struct<>" in files._jdf.queryExecution().executedPlan().toString()
