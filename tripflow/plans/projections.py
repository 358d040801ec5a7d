"""Projections, filters, null handling, scalar functions."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType

from tripflow.functions import (
    banded,
    elapsed_minutes,
    elapsed_whole_minutes,
    split_part_at,
    square_udf,
)
from tripflow.plans.base import query, table
from tripflow.streaming.messages import parse_messages

# --- projections -----------------------------------------------------------


@query("select_alias", "SELECT l_orderkey, l_partkey, l_quantity AS quantity FROM lineitem")
def select_alias(spark, sf):
    return table(spark, sf, "lineitem").select("l_orderkey", F.col("l_partkey"), F.col("l_quantity").alias("quantity"))


@query(
    "rename_column",
    "SELECT c_custkey, c_name, c_nationkey, c_acctbal AS balance, c_mktsegment FROM customer",
)
def rename_column(spark, sf):
    return table(spark, sf, "customer").withColumnRenamed("c_acctbal", "balance")


@query("constant_column", "SELECT event_id, event_type, value, 'event' AS record_kind FROM events")
def constant_column(spark, sf):
    return table(spark, sf, "events").select("event_id", "event_type", "value").withColumn("record_kind", F.lit("event"))


@query(
    "computed_totals",
    """SELECT l_orderkey, l_linenumber, l_extendedprice * (1 - l_discount) AS net_price,
              l_extendedprice * (1 - l_discount) * (1 + l_tax) AS charged,
              l_extendedprice / (l_quantity + 1) AS unit_share
       FROM lineitem""",
)
def computed_totals(spark, sf):
    price, quantity = F.col("l_extendedprice"), F.col("l_quantity")
    net = price * (1 - F.col("l_discount"))
    return table(spark, sf, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        net.alias("net_price"),
        (net * (1 + F.col("l_tax"))).alias("charged"),
        (price / (quantity + 1)).alias("unit_share"),
    )


@query("drop_columns", "SELECT p_partkey, p_brand, p_size, p_retailprice FROM part")
def drop_columns(spark, sf):
    return table(spark, sf, "part").drop("p_name", "p_type")


@query(
    "cast_columns",
    """SELECT CAST(o_orderkey AS VARCHAR) AS order_text, CAST(o_custkey AS DOUBLE) AS cust_double,
              TRY_CAST(o_orderpriority AS INTEGER) AS priority_number,
              CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS priority_level
       FROM orders""",
)
def cast_columns(spark, sf):
    priority = F.col("o_orderpriority")
    return table(spark, sf, "orders").select(
        F.col("o_orderkey").cast(StringType()).alias("order_text"),
        F.col("o_custkey").cast("double").alias("cust_double"),
        priority.try_cast(IntegerType()).alias("priority_number"),
        F.substring(priority, 1, 1).cast("int").alias("priority_level"),
    )


@query(
    "case_flags",
    """SELECT p_partkey, p_size >= 40 AS bulky,
              CASE WHEN p_size IS NULL OR p_retailprice IS NULL THEN 'unrated'
                   WHEN p_size >= 40 AND p_retailprice <= 950 THEN 'bargain'
                   WHEN p_size <= 10 AND p_retailprice >= 950 THEN 'dear'
                   ELSE 'usual' END AS value_class
       FROM part""",
)
def case_flags(spark, sf):
    """Conditions over two columns, tried in turn; what is missing is told apart first."""
    size, price = F.col("p_size"), F.col("p_retailprice")
    bulky = size >= 40
    value_class = (
        F.when(size.isNull() | price.isNull(), "unrated")
        .when(bulky & (price <= 950), "bargain")
        .when((size <= 10) & (price >= 950), "dear")
        .otherwise("usual")
    )
    return table(spark, sf, "part").select("p_partkey", bulky.alias("bulky"), value_class.alias("value_class"))


SIZE_BANDS = ((10, "small"), (25, "medium"), (40, "large"))
SIZE_SQL = """CASE WHEN p_size <= 10 THEN 'small' WHEN p_size <= 25 THEN 'medium' WHEN p_size <= 40 THEN 'large'
    WHEN p_size IS NOT NULL THEN 'oversize' END"""


def parts_by_size(spark, sf):
    """Parts with the band of their size."""
    return table(spark, sf, "part").withColumn("size_band", banded(F.col("p_size"), SIZE_BANDS, "oversize"))


@query(
    "life_stage",
    f"""SELECT p_partkey, p_size, size_band FROM (SELECT *, {SIZE_SQL} AS size_band FROM part)
        WHERE size_band IN ('small', 'oversize')""",
)
def life_stage(spark, sf):
    """Rows chosen by a computed label."""
    extremes = parts_by_size(spark, sf).where(F.col("size_band").isin(["small", "oversize"]))
    return extremes.select("p_partkey", "p_size", "size_band")


# --- filters ---------------------------------------------------------------


@query("filter_equality", "SELECT * FROM orders WHERE o_orderstatus = 'F'")
def filter_equality(spark, sf):
    return table(spark, sf, "orders").filter(F.col("o_orderstatus") == "F")


@query(
    "filter_conjunction",
    """SELECT l_orderkey, l_linenumber, l_quantity, l_discount FROM lineitem
       WHERE l_returnflag = 'R' AND l_quantity < 10 AND l_discount >= 0.05 AND l_tax <= 0.06 AND l_linenumber > 1""",
)
def filter_conjunction(spark, sf):
    kept = table(spark, sf, "lineitem").filter(
        (F.col("l_returnflag") == "R")
        & (F.col("l_quantity") < 10)
        & (F.col("l_discount") >= 0.05)
        & (F.col("l_tax") <= 0.06)
        & (F.col("l_linenumber") > 1)
    )
    return kept.select("l_orderkey", "l_linenumber", "l_quantity", "l_discount")


@query(
    "filter_disjunction",
    "SELECT event_id, event_type, value FROM events WHERE event_type = 'purchase' OR value > 100",
)
def filter_disjunction(spark, sf):
    kept = table(spark, sf, "events").filter((F.col("event_type") == "purchase") | (F.col("value") > 100))
    return kept.select("event_id", "event_type", "value")


# The tables hold no nulls: here certain values stand for a missing one.
GAPS_SQL = """SELECT event_id, nullif(event_type, 'error') AS event_type,
                     CASE WHEN user_id % 7 = 0 THEN NULL ELSE user_id END AS user_id,
                     CASE WHEN event_type IN ('error', 'view') THEN NULL ELSE value END AS value FROM events"""


def events_with_gaps(spark, sf):
    return table(spark, sf, "events").select(
        "event_id",
        F.nullif("event_type", F.lit("error")).alias("event_type"),
        F.when(F.col("user_id") % 7 != 0, F.col("user_id")).alias("user_id"),
        F.when(~F.col("event_type").isin("error", "view"), F.col("value")).alias("value"),
    )


@query(
    "filter_null_isin",
    f"SELECT * FROM ({GAPS_SQL}) WHERE value IS NULL AND event_type IN ('view', 'click')",
)
def filter_null_isin(spark, sf):
    return events_with_gaps(spark, sf).filter(F.col("value").isNull() & F.col("event_type").isin("view", "click"))


@query("filter_not_null", f"SELECT * FROM ({GAPS_SQL}) WHERE user_id IS NOT NULL")
def filter_not_null(spark, sf):
    return events_with_gaps(spark, sf).filter(F.col("user_id").isNotNull())


@query("filter_between", "SELECT p_partkey, p_size FROM part WHERE p_size BETWEEN 13 AND 19")
def filter_between(spark, sf):
    return table(spark, sf, "part").where(F.col("p_size").between(13, 19)).select("p_partkey", "p_size")


# --- null handling ---------------------------------------------------------

MEASURES = ["event_type", "user_id", "value"]


@query(
    "dropna_all",
    f"""SELECT event_type, user_id, value FROM ({GAPS_SQL})
        WHERE event_type IS NOT NULL OR user_id IS NOT NULL OR value IS NOT NULL""",
)
def dropna_all(spark, sf):
    return events_with_gaps(spark, sf).select(*MEASURES).dropna("all")


@query(
    "dropna_any",
    f"""SELECT event_type, user_id, value FROM ({GAPS_SQL})
        WHERE event_type IS NOT NULL AND user_id IS NOT NULL AND value IS NOT NULL""",
)
def dropna_any(spark, sf):
    return events_with_gaps(spark, sf).select(*MEASURES).dropna("any")


@query("dropna_subset", f"SELECT * FROM ({GAPS_SQL}) WHERE event_type IS NOT NULL")
def dropna_subset(spark, sf):
    return events_with_gaps(spark, sf).dropna(subset=["event_type"])


@query(
    "fillna_all",
    f"SELECT event_id, coalesce(event_type, 'unrecorded') AS event_type, user_id, value FROM ({GAPS_SQL})",
)
def fillna_all(spark, sf):
    return events_with_gaps(spark, sf).fillna("unrecorded")


@query(
    "fillna_subset",
    f"""SELECT event_id, coalesce(event_type, 'unrecorded') AS event_type, label
        FROM (SELECT *, nullif(event_type, 'view') AS label FROM ({GAPS_SQL}))""",
)
def fillna_subset(spark, sf):
    gaps = events_with_gaps(spark, sf).withColumn("label", F.nullif("event_type", F.lit("view")))
    return gaps.select("event_id", "event_type", "label").fillna("unrecorded", subset=["event_type"])


@query(
    "coalesce_default",
    f"SELECT event_id, coalesce(value, 0.0) AS value FROM ({GAPS_SQL})",
)
def coalesce_default(spark, sf):
    gaps = events_with_gaps(spark, sf)
    return gaps.select("event_id", F.coalesce(F.col("value"), F.lit(0.0)).cast("double").alias("value"))


# --- text and arrays -------------------------------------------------------


@query(
    "str_case",
    """SELECT p_partkey, upper(p_name) AS upper_name, lower(p_type) AS lower_type,
              array_to_string(list_transform(string_split(lower(p_name), ' '),
                                             lambda w: upper(w[1:1]) || w[2:]), ' ') AS title_name
       FROM part""",
)
def str_case(spark, sf):
    return table(spark, sf, "part").select(
        "p_partkey",
        F.upper("p_name").alias("upper_name"),
        F.lower("p_type").alias("lower_type"),
        F.initcap("p_name").alias("title_name"),
    )


@query(
    "str_regexp_replace",
    """SELECT p_partkey, regexp_replace(regexp_replace(p_brand, 'Brand', 'Br', 'g'), '#', '-', 'g') AS p_brand
       FROM part""",
)
def str_regexp_replace(spark, sf):
    short = F.regexp_replace(F.col("p_brand"), "Brand", "Br")
    return table(spark, sf, "part").select("p_partkey", F.regexp_replace(short, "#", "-").alias("p_brand"))


@query(
    "str_split_index",
    """SELECT p_partkey, string_split(p_name, ' ')[1] AS first_word, string_split(p_name, ' ')[2] AS second_word,
              string_split(p_name, ' ')[3] AS third_word, string_split(p_brand, '#')[2] AS brand_number
       FROM part""",
)
def str_split_index(spark, sf):
    return table(spark, sf, "part").select(
        "p_partkey",
        split_part_at("p_name", " ", 0).alias("first_word"),
        split_part_at("p_name", " ", 1).alias("second_word"),
        split_part_at("p_name", " ", 2).alias("third_word"),
        split_part_at("p_brand", "#", 1).alias("brand_number"),
    )


@query(
    "array_explode",
    "SELECT doc_id, unnest(string_split(text, ' ')) AS word FROM documents",
)
def array_explode(spark, sf):
    words = table(spark, sf, "documents").select("doc_id", F.split("text", " ").alias("word"))
    return words.withColumn("word", F.explode("word"))


@query(
    "array_contains",
    "SELECT p_partkey, list_contains(string_split(p_name, ' '), 'widget') AS widget_flag FROM part",
)
def array_contains(spark, sf):
    words = F.split("p_name", " ")
    return table(spark, sf, "part").select("p_partkey", F.array_contains(words, "widget").alias("widget_flag"))


# --- dates and times -------------------------------------------------------


@query(
    "date_current",
    """SELECT event_id, current_date AS run_date, CAST(current_date + 7 AS DATE) AS due_in_7,
              CAST(date_diff('day', CAST(ts AS DATE), current_date) AS INTEGER) AS age_days
       FROM events""",
)
def date_current(spark, sf):
    today = F.current_date()
    return table(spark, sf, "events").select(
        "event_id",
        today.alias("run_date"),
        F.date_add(today, 7).alias("due_in_7"),
        F.datediff(today, F.col("ts").cast("date")).alias("age_days"),
    )


@query(
    "date_arith",
    """SELECT o_orderkey, d AS order_date, CAST(d + 7 AS DATE) AS due_in_7, CAST(d - 7 AS DATE) AS due_7_ago,
              CAST(d - 7 AS DATE) AS due_7_back, 7 AS days_forward, -7 AS days_back
       FROM (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d FROM orders)""",
)
def date_arith(spark, sf):
    day = F.col("order_date")
    dated = table(spark, sf, "orders").select("o_orderkey", F.col("o_orderdate").cast("date").alias("order_date"))
    weeks = dated.withColumns(
        {
            "due_in_7": F.date_add(day, 7),
            "due_7_ago": F.date_add(day, -7),
            "due_7_back": F.date_sub(day, 7),
        }
    )
    return weeks.withColumns(
        {"days_forward": F.datediff("due_in_7", "order_date"), "days_back": F.datediff("order_date", "due_in_7")}
    )


@query("date_format", "SELECT o_orderkey, strftime(o_orderdate, '%d-%m-%Y') AS day_text FROM orders")
def date_format(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", F.date_format("o_orderdate", "dd-MM-yyyy").alias("day_text"))


TIME_TEXT_SQL = """SELECT event_id, CASE WHEN event_type = 'error' THEN 'no time'
                          ELSE strftime(date_trunc('second', ts), '%Y-%m-%d %H:%M:%S') END AS ts_text FROM events"""


@query(
    "ts_parse",
    f"SELECT event_id, ts_text, try_strptime(ts_text, '%Y-%m-%d %H:%M:%S') AS parsed FROM ({TIME_TEXT_SQL})",
)
def ts_parse(spark, sf):
    """Text to timestamp; text that is no time gives null."""
    text = F.when(F.col("event_type") == "error", "no time").otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))
    texts = table(spark, sf, "events").select("event_id", text.alias("ts_text"))
    return texts.withColumn("parsed", F.try_to_timestamp("ts_text").cast("timestamp_ntz"))


# An end time per event, from 5 minutes before to 85 minutes after its start.
SPAN_SQL = """SELECT event_id, ts AS started,
                     ts + to_microseconds(CAST((event_id * 7919 % 5400 - 300) * 1000000 + 400000 AS BIGINT)) AS ended
              FROM events"""


def event_spans(spark, sf):
    offset = F.expr("make_dt_interval(0, 0, 0, event_id * 7919 % 5400 - 300 + 0.4)")
    return table(spark, sf, "events").select("event_id", F.col("ts").alias("started"), (F.col("ts") + offset).alias("ended"))


@query(
    "duration_minutes",
    f"""SELECT event_id, (CAST(floor(epoch(ended)) AS BIGINT) - CAST(floor(epoch(started)) AS BIGINT)) / 60e0
               AS trip_duration_minutes
        FROM ({SPAN_SQL})""",
)
def duration_minutes(spark, sf):
    spans = event_spans(spark, sf)
    return spans.select("event_id", elapsed_minutes("started", "ended").alias("trip_duration_minutes"))


@query(
    "duration_whole_minutes",
    f"SELECT event_id, date_sub('minute', started, ended) AS trip_duration_minutes FROM ({SPAN_SQL})",
)
def duration_whole_minutes(spark, sf):
    spans = event_spans(spark, sf)
    return spans.select("event_id", elapsed_whole_minutes("started", "ended").alias("trip_duration_minutes"))


@query(
    "hour_weekday",
    """SELECT event_id, CAST(hour(ts) AS INTEGER) AS event_hour, CAST(dayofweek(ts) + 1 AS INTEGER) AS event_weekday
       FROM events""",
)
def hour_weekday(spark, sf):
    return table(spark, sf, "events").select(
        "event_id", F.hour("ts").alias("event_hour"), F.dayofweek("ts").alias("event_weekday")
    )


# --- JSON and Python functions ---------------------------------------------


@query(
    "json_extract",
    "SELECT event_id, event_type, CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events",
)
def json_extract(spark, sf):
    return parse_messages(table(spark, sf, "events").select("event_id", "event_type", "props"), "k int", "props")


@query("udf_square", "SELECT p_partkey, p_retailprice * p_retailprice AS squared FROM part")
def udf_square(spark, sf):
    return table(spark, sf, "part").select("p_partkey", square_udf()("p_retailprice").alias("squared"))


@query("builtin_square", "SELECT p_partkey, p_retailprice * p_retailprice AS squared FROM part")
def builtin_square(spark, sf):
    return table(spark, sf, "part").select("p_partkey", (F.col("p_retailprice") * F.col("p_retailprice")).alias("squared"))
