"""Scans, file round trips, catalog tables and the SQL surface.

Every query that writes takes a folder or names that nobody used before, below
the shared folder of the session, and returns what it reads back.
"""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, LongType, StringType, StructField, StructType

from tripflow.operators import word_counts
from tripflow.plans.base import query, table
from tripflow.plans.projections import SIZE_SQL, parts_by_size
from tripflow.session import scratch_path, shuffle_parts, unique_name
from tripflow.sources import (
    bronze_sample,
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
from tripflow.sources.files import rows_per_file, sample_cells, sample_rows, schema_rows
from tripflow.sources.sinks import publish_version


TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def fresh_layer(spark, prefix: str) -> str:
    name = unique_name(prefix)
    return ensure_layer(spark, name, scratch_path(spark, name))


@query("scan_parquet", "SELECT * FROM part")
def scan_parquet(spark, sf):
    return read_parquet(spark, f"{sf}/part.parquet")


def _split_orders(spark, sf):
    base = scratch_path(spark, "orders")
    orders = table(spark, sf, "orders")
    done = F.col("o_orderstatus") == "F"
    save(orders.filter(done), f"{base}/done")
    save(orders.filter(~done), f"{base}/open")
    return base


@query("scan_parquet_multi", "SELECT * FROM orders")
def scan_parquet_multi(spark, sf):
    """Several paths in one scan."""
    base = _split_orders(spark, sf)
    return read_parquet(spark, f"{base}/done", f"{base}/open")


@query("scan_parquet_directory", "SELECT * FROM orders WHERE o_orderstatus = 'F'")
def scan_parquet_directory(spark, sf):
    """A folder that holds all orders in several files."""
    path = scratch_path(spark, "orders")
    save(table(spark, sf, "orders").repartition(shuffle_parts(spark)), path)
    return read_parquet(spark, path).filter(F.col("o_orderstatus") == "F")


CUSTOMER_DDL = "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING"


@query("csv_roundtrip", "SELECT * FROM customer")
def csv_roundtrip(spark, sf):
    path = scratch_path(spark, "customer_csv")
    save(table(spark, sf, "customer"), path, "csv", header=True)
    return read_csv(spark, path, CUSTOMER_DDL)


@query(
    "csv_inferred",
    """SELECT CAST(p_partkey AS INTEGER) AS p_partkey, p_name, p_brand, p_type, p_size, p_retailprice FROM part""",
)
def csv_inferred(spark, sf):
    path = scratch_path(spark, "part_csv")
    save(table(spark, sf, "part"), path, "csv", mode="overwrite", header=True)
    return read_csv(spark, path)


@query("csv_struct_schema", "SELECT s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier")
def csv_struct_schema(spark, sf):
    schema = StructType(
        [
            StructField("s_suppkey", LongType()),
            StructField("s_name", StringType()),
            StructField("s_nationkey", IntegerType()),
            StructField("s_acctbal", DoubleType()),
        ]
    )
    path = scratch_path(spark, "supplier_csv")
    save(table(spark, sf, "supplier"), path, "csv", header=True)
    return read_csv(spark, path, schema)


@query("json_roundtrip", "SELECT event_id, event_type, props, user_id, value FROM events")
def json_roundtrip(spark, sf):
    path = scratch_path(spark, "events_json")
    save(table(spark, sf, "events").drop("ts"), path, "json")
    return read_json_lines(spark, path)


@query(
    "text_lines",
    r"""SELECT word, count(*) AS n FROM (
            SELECT unnest(string_split(line, ' ')) AS word FROM (
                SELECT unnest(string_split_regex(text, '\r\n|\r|\n')) AS line FROM conversations))
        GROUP BY word""",
)
def text_lines(spark, sf):
    """Word count over a text file."""
    path = scratch_path(spark, "lines")
    save(table(spark, sf, "conversations").select("text"), path, "text")
    return word_counts(read_text_lines(spark, path))


@query(
    "discover_files",
    " UNION ALL ".join(
        f"SELECT '{name}.parquet' AS entry, count(*) AS rows, true AS has_bytes FROM {name}" for name in TABLES
    ),
)
def list_files(spark, sf):
    """Every table's files, listed and counted."""
    files = rows_per_file(spark, sf).groupBy("entry")
    return files.agg(F.sum("rows").alias("rows"), (F.min("length") > 0).alias("has_bytes"))


def _typed(name: str) -> str:
    """SQL for the columns of a table, with their types as Spark names them."""
    return f"""SELECT '{name}' AS dataset, column_name AS name, CASE column_type WHEN 'VARCHAR' THEN 'string'
        WHEN 'INTEGER' THEN 'int' WHEN 'TIMESTAMP' THEN 'timestamp_ntz' ELSE lower(column_type) END AS type
        FROM (DESCRIBE {name})"""


def _first_cells(name: str) -> str:
    """SQL for the values of the first five rows of a table, as text."""
    return f"""SELECT '{name}' AS dataset, position, name, value FROM (
            SELECT position, CAST(COLUMNS(* EXCLUDE (position)) AS VARCHAR)
            FROM (SELECT *, row_number() OVER () AS position FROM {name} LIMIT 5))
        UNPIVOT INCLUDE NULLS (value FOR name IN (COLUMNS(* EXCLUDE (position))))"""


@query(
    "bronze_sample",
    f"""SELECT dataset, CAST(1 AS INTEGER) AS file_no, position, name, type, value
        FROM ({_first_cells("lineitem")} UNION ALL {_first_cells("orders")})
        JOIN ({_typed("lineitem")} UNION ALL {_typed("orders")}) USING (dataset, name)""",
)
def sample_bronze(spark, sf):
    """The first rows of the first files of each dataset, value by value, with their types; a pattern without files gives none."""
    patterns = {"lineitem": "lineitem*.parquet", "orders": "orders*.parquet", "returns": "returns*.parquet"}
    frames = bronze_sample(spark, sf, patterns, files=1)
    types = schema_rows(spark, frames).drop("position")
    return sample_cells(sample_rows(spark, frames)).join(F.broadcast(types), ["dataset", "file_no", "name"])  # a row per column


@query("table_roundtrip", "SELECT * FROM orders")
def table_roundtrip(spark, sf):
    """Write, overwrite and read a managed table; drop another one."""
    layer = fresh_layer(spark, "roundtrip")
    orders = table(spark, sf, "orders")
    orders.limit(1).write.saveAsTable(f"{layer}.doomed")
    spark.sql(f"DROP TABLE IF EXISTS {layer}.doomed")
    spark.sql(f"DROP TABLE IF EXISTS {layer}.doomed")
    orders.limit(1).write.mode("overwrite").saveAsTable(f"{layer}.orders")
    orders.write.mode("overwrite").saveAsTable(f"{layer}.orders")
    if table_exists(spark, f"{layer}.doomed") or not table_exists(spark, f"{layer}.orders"):
        raise RuntimeError("the catalog does not show the tables as written")
    return read_table(spark, f"{layer}.orders")


SAVE_STEPS_SQL = """SELECT step, CAST(factor * n AS BIGINT) AS n
    FROM (SELECT count(*) AS n FROM customer),
         (VALUES ('errorifexists', 1), ('append', 2), ('append_option', 3), ('ignore', 3), ('overwrite', 1),
                 ('parquet_overwrite', 1)) AS s(step, factor)"""


@query("save_modes", SAVE_STEPS_SQL)
def save_modes(spark, sf):
    """Rows at the path after each save mode in turn."""
    customer = table(spark, sf, "customer")
    path = scratch_path(spark, "modes")
    steps = []

    def after(step, fmt="csv"):
        rows = spark.read.format(fmt).schema(CUSTOMER_DDL).load(path).count()
        steps.append((step, rows))

    save(customer, path, "csv", "errorifexists")
    after("errorifexists")
    save(customer, path, "csv", "append")
    after("append")
    customer.write.format("csv").mode("append").option("path", path).save()
    after("append_option")
    save(customer, path, "csv", "ignore")
    after("ignore")
    save(customer, path, "csv", "overwrite")
    after("overwrite")
    save(customer, path, "parquet", "overwrite")
    after("parquet_overwrite", "parquet")
    return spark.createDataFrame(steps, "step string, n bigint")


@query("publish_table", "SELECT o_orderkey, o_totalprice FROM orders")
def publish(spark, sf):
    """Create the table, then replace it by one with other columns."""
    layer = fresh_layer(spark, "publish")
    orders = table(spark, sf, "orders")
    publish_table(orders.select("o_orderkey", "o_orderstatus"), f"{layer}.orders")
    publish_table(orders.select("o_orderkey", "o_totalprice"), f"{layer}.orders")
    return read_table(spark, f"{layer}.orders")


@query("publish_versions", "SELECT o_orderkey, o_totalprice FROM orders")
def publish_versions(spark, sf):
    """Three versions of a table under one name, the last with other columns; the name is never missing."""
    name = f"{fresh_layer(spark, 'versions')}.orders"
    orders = table(spark, sf, "orders")
    for columns in (["o_orderkey"], ["o_orderkey", "o_orderstatus"], ["o_orderkey", "o_totalprice"]):
        publish_version(orders.select(*columns), name)
    return read_table(spark, name)


@query(
    "ingest_bronze",
    """SELECT s_suppkey, s_name, CAST(s_nationkey AS INTEGER) AS s_nationkey, n_name
       FROM supplier JOIN nation ON s_nationkey = n_nationkey""",
)
def ingest_bronze(spark, sf):
    """Copy a Parquet and a CSV input into bronze and read both there."""
    raw, bronze = scratch_path(spark, "raw"), scratch_path(spark, "bronze")
    save(table(spark, sf, "nation"), f"{raw}/nation", "csv", header=True)
    ingest(spark, f"{sf}/supplier.parquet", f"{bronze}/supplier", "parquet")
    ingest(spark, f"{raw}/nation", f"{bronze}/nation", "csv")
    supplier, nation = read_parquet(spark, f"{bronze}/supplier"), read_csv(spark, f"{bronze}/nation")
    joined = supplier.join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
    return joined.select("s_suppkey", "s_name", "s_nationkey", "n_name")


@query(
    "sql_insert",
    f"""SELECT p_partkey, p_size, size_band FROM (
            SELECT p_partkey, p_size, {SIZE_SQL} AS size_band FROM part UNION ALL SELECT -1, 99, 'unlisted')
        WHERE size_band IN ('medium', 'unlisted')""",
)
def sql_insert(spark, sf):
    """A managed table, a row inserted by SQL and a SQL query over it."""
    banded_parts = f"{fresh_layer(spark, 'parts')}.by_size"
    parts_by_size(spark, sf).select("p_partkey", "p_size", "size_band").write.saveAsTable(banded_parts)
    spark.sql(f"INSERT INTO {banded_parts} VALUES (-1, 99, 'unlisted')")
    return spark.sql(f"SELECT * FROM {banded_parts} WHERE size_band IN ('medium', 'unlisted')")


@query("sql_temp_view", "SELECT * FROM orders WHERE o_orderpriority = '5-LOW'")
def sql_temp_view(spark, sf):
    view = unique_name("orders")
    register_view(table(spark, sf, "orders"), view)
    return spark.sql(f"SELECT * FROM {view} WHERE o_orderpriority = '5-LOW'")


@query(
    "inline_names",
    f"""SELECT size_band, CAST(shelf AS BIGINT) AS shelf, count(*) AS n, min(p_partkey) AS first_part
        FROM (SELECT *, {SIZE_SQL} AS size_band FROM part)
        JOIN (VALUES ('small', 1), ('medium', 2), ('oversize', 7)) AS t(band, shelf) ON size_band = band
        GROUP BY size_band, shelf""",
)
def inline_names(spark, sf):
    """Rows given in the program with names alone, their types found by Spark."""
    shelves = spark.createDataFrame([("small", 1), ("medium", 2), ("oversize", 7)], ["band", "shelf"])
    joined = parts_by_size(spark, sf).join(F.broadcast(shelves), F.col("size_band") == F.col("band"))  # three rows
    return joined.groupBy("size_band", "shelf").agg(F.count("*").alias("n"), F.min("p_partkey").alias("first_part"))
