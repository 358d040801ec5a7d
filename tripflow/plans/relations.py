"""Joins, grouping, windows, sorting and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from tripflow.operators import (
    Key,
    collect_values,
    first_per_key,
    number_rows,
    outer_join,
    rank_rows,
    running_total,
    sort_rows,
    with_total,
    word_counts,
)
from tripflow.operators.sampling import hash_bound, sample_by_hash
from tripflow.plans.base import query, table
from tripflow.session import scratch_scope
from tripflow.plans.projections import SIZE_SQL, parts_by_size

# --- joins -----------------------------------------------------------------


@query(
    "join_inner",
    """SELECT o_orderkey, o_custkey, c_custkey, c_name, o_totalprice
       FROM orders JOIN customer ON o_custkey = c_custkey""",
)
def join_inner(spark, sf):
    orders, customer = table(spark, sf, "orders"), table(spark, sf, "customer")
    joined = orders.join(customer, orders["o_custkey"] == customer["c_custkey"], "inner")
    return joined.select("o_orderkey", "o_custkey", "c_custkey", "c_name", "o_totalprice")


def _labels(spark, sf):
    """Labels, their key renamed to stand beside the documents' own."""
    return table(spark, sf, "labels").withColumnRenamed("doc_id", "label_doc_id")


@query(
    "join_left",
    """SELECT d.doc_id, d.lang, l.doc_id AS label_doc_id, l.quality, l.toxic
       FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""",
)
def join_left(spark, sf):
    documents, labels = table(spark, sf, "documents"), _labels(spark, sf)
    joined = outer_join(documents, labels, [("doc_id", "label_doc_id")])
    return joined.select("doc_id", "lang", "label_doc_id", "quality", "toxic")


@query(
    "join_right",
    """SELECT l.doc_id AS label_doc_id, l.quality, d.doc_id, d.source
       FROM (SELECT * FROM labels WHERE quality = 1) l RIGHT JOIN documents d ON l.doc_id = d.doc_id""",
)
def join_right(spark, sf):
    good, documents = _labels(spark, sf).filter("quality = 1"), table(spark, sf, "documents")
    joined = outer_join(good, documents, [("label_doc_id", "doc_id")], "right")
    return joined.select("label_doc_id", "quality", "doc_id", "source")


@query(
    "join_anti",
    """SELECT doc_id, lang, source, n_chars FROM documents
       WHERE NOT EXISTS (SELECT 1 FROM labels WHERE labels.doc_id = documents.doc_id)""",
)
def join_anti(spark, sf):
    documents, labels = table(spark, sf, "documents"), _labels(spark, sf)
    rest = documents.join(labels, documents["doc_id"] == labels["label_doc_id"], "left_anti")
    return rest.select("doc_id", "lang", "source", "n_chars")


@query(
    "inline_rows",
    """SELECT event_type, label, count(*) AS n FROM events
       JOIN (VALUES ('click', 'active'), ('view', 'passive'), ('purchase', 'active')) AS t(name, label)
         ON event_type = name
       GROUP BY event_type, label""",
)
def inline_rows(spark, sf):
    """Rows given in the program, joined as a lookup of fixed size."""
    rows = [("click", "active"), ("view", "passive"), ("purchase", "active")]
    labels = spark.createDataFrame(rows, "name STRING, label STRING")
    joined = table(spark, sf, "events").join(F.broadcast(labels), F.col("event_type") == F.col("name"))
    return joined.groupBy("event_type", "label").agg(F.count("*").alias("n"))


# --- grouping --------------------------------------------------------------


@query(
    "agg_sum",
    "SELECT l_returnflag, round(sum(l_extendedprice), 2) AS total_price FROM lineitem GROUP BY l_returnflag",
)
def agg_sum(spark, sf):
    return table(spark, sf, "lineitem").groupBy("l_returnflag").agg(
        F.round(F.sum("l_extendedprice"), 2).alias("total_price")
    )


@query("agg_avg", "SELECT event_type, round(avg(value), 6) AS avg_value FROM events GROUP BY event_type")
def agg_avg(spark, sf):
    return table(spark, sf, "events").groupBy("event_type").agg(F.round(F.avg("value"), 6).alias("avg_value"))


@query(
    "agg_multi_key",
    """SELECT l_returnflag, l_linestatus, sum(l_quantity) AS total_quantity
       FROM lineitem GROUP BY l_returnflag, l_linestatus""",
)
def agg_multi_key(spark, sf):
    groups = table(spark, sf, "lineitem").groupBy("l_returnflag", "l_linestatus")
    return groups.agg(F.sum("l_quantity").alias("total_quantity"))


@query(
    "agg_multi",
    """SELECT l_suppkey, l_returnflag, sum(l_quantity) AS total_quantity,
              round(avg(l_extendedprice), 6) AS avg_price
       FROM lineitem GROUP BY l_suppkey, l_returnflag""",
)
def agg_multi(spark, sf):
    groups = table(spark, sf, "lineitem").groupBy("l_suppkey", "l_returnflag")
    return groups.agg(
        F.sum("l_quantity").alias("total_quantity"), F.round(F.avg("l_extendedprice"), 6).alias("avg_price")
    )


@query(
    "life_stage_avg",
    f"""SELECT {SIZE_SQL} AS size_band, round(avg(p_partkey), 6) AS avg_p_partkey,
               round(avg(p_size), 6) AS avg_p_size, round(avg(p_retailprice), 6) AS avg_p_retailprice
        FROM part GROUP BY 1""",
)
def life_stage_avg(spark, sf):
    """Average of every numeric column per group."""
    means = parts_by_size(spark, sf).groupBy("size_band").avg()
    return means.select(
        "size_band", *(F.round(means[c], 6).alias("avg_" + c[4:-1]) for c in means.columns if c != "size_band")
    )


@query("sql_global_avg", "SELECT round(avg(p_size), 6) AS mean_size FROM part")
def sql_global_avg(spark, sf):
    return spark.sql("SELECT round(avg(p_size), 6) AS mean_size FROM {parts}", parts=table(spark, sf, "part"))


@query("sql_group_avg", f"SELECT {SIZE_SQL} AS size_band, round(avg(p_size), 6) AS mean_size FROM part GROUP BY 1")
def sql_group_avg(spark, sf):
    return spark.sql(
        "SELECT size_band, round(avg(p_size), 6) AS mean_size FROM {parts} GROUP BY size_band",
        parts=parts_by_size(spark, sf),
    )


@query(
    "collect_list",
    """SELECT user_id, CAST(pos // 100000 AS BIGINT) AS segment, list(event_type ORDER BY event_type) AS event_types
       FROM (SELECT user_id, event_type, row_number() OVER (PARTITION BY user_id ORDER BY event_type) - 1 AS pos
             FROM events)
       GROUP BY user_id, segment""",
)
def collect_list(spark, sf):
    return collect_values(table(spark, sf, "events"), "user_id", "event_type", 100_000, "event_types")


@query(
    "pivot_avg",
    """SELECT l_returnflag, round(avg(l_extendedprice) FILTER (l_linestatus = 'F'), 6) AS "F",
              round(avg(l_extendedprice) FILTER (l_linestatus = 'O'), 6) AS "O"
       FROM lineitem GROUP BY l_returnflag""",
)
def pivot_avg(spark, sf):
    groups = table(spark, sf, "lineitem").groupBy("l_returnflag")
    return groups.pivot("l_linestatus").agg(F.round(F.avg("l_extendedprice"), 6))


@query("row_count", "SELECT count(*) AS n FROM lineitem")
def row_count(spark, sf):
    return table(spark, sf, "lineitem").agg(F.count("*").alias("n"))


@query("distinct_rows", "SELECT DISTINCT l_suppkey, l_linenumber, l_returnflag, l_tax FROM lineitem")
def distinct_rows(spark, sf):
    return table(spark, sf, "lineitem").select("l_suppkey", "l_linenumber", "l_returnflag", "l_tax").distinct()


LINE_COLUMNS = [
    "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
    "l_returnflag", "l_linestatus", "l_shipdate",
]


def _line_order(*first: str) -> str:
    """An ORDER BY over lineitem that ends with all remaining columns."""
    named = {f.split()[0] for f in first}
    return ", ".join([*first, *(f"{c} ASC NULLS FIRST" for c in LINE_COLUMNS if c not in named)])


@query(
    "dedup_by_key",
    f"""SELECT {", ".join(LINE_COLUMNS)}
        FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY {_line_order("l_shipdate")}) AS rn
              FROM lineitem) WHERE rn = 1""",
)
def dedup_by_key(spark, sf):
    """The earliest line of every order."""
    return first_per_key(table(spark, sf, "lineitem"), ["l_orderkey"], ["l_shipdate"])


@query(
    "word_count",
    "SELECT word, count(*) AS n FROM (SELECT unnest(string_split(text, ' ')) AS word FROM documents) GROUP BY word",
)
def word_count(spark, sf):
    return word_counts(table(spark, sf, "documents"), "text")


# --- windows over the whole table ------------------------------------------


@query(
    "win_row_number",
    f"""SELECT {", ".join(LINE_COLUMNS)}, row_number() OVER (ORDER BY {_line_order("l_shipdate")}) AS row_number
        FROM lineitem""",
)
def win_row_number(spark, sf):
    return number_rows(table(spark, sf, "lineitem"), ["l_shipdate"])


@query(
    "win_rank",
    """SELECT l_orderkey, l_linenumber, l_shipdate, rank() OVER (ORDER BY l_shipdate DESC) AS rank,
              dense_rank() OVER (ORDER BY l_shipdate DESC) AS dense_rank
       FROM lineitem""",
)
def win_rank(spark, sf):
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate")
    return rank_rows(lines, [Key("l_shipdate", ascending=False)])


@query(
    "win_cumsum_rows",
    """SELECT event_id, event_type, value, round(sum(value) OVER (
                  ORDER BY event_type, event_id, value ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 2) AS value_so_far
       FROM events""",
)
def win_cumsum_rows(spark, sf):
    events = table(spark, sf, "events").select("event_id", "event_type", "value")
    return running_total(events, "value", ["event_type", "event_id"], "value_so_far").withColumn(
        "value_so_far", F.round("value_so_far", 2)
    )


@query(
    "win_cumsum_range",
    """SELECT l_orderkey, l_linenumber, l_shipdate, l_quantity, sum(l_quantity) OVER (ORDER BY l_shipdate) AS quantity_so_far
       FROM lineitem""",
)
def win_cumsum_range(spark, sf):
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate", "l_quantity")
    return running_total(lines, "l_quantity", ["l_shipdate"], "quantity_so_far", frame="range")


@query(
    "win_total",
    "SELECT l_orderkey, l_linenumber, l_quantity, sum(l_quantity) OVER () AS quantity_overall FROM lineitem",
)
def win_total(spark, sf):
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    return with_total(lines, "l_quantity", "quantity_overall")


@query(
    "scoped_rank",
    """SELECT o_orderkey, o_orderdate, rank() OVER (ORDER BY o_orderdate) AS rank,
              dense_rank() OVER (ORDER BY o_orderdate) AS dense_rank FROM orders""",
)
def scoped_rank(spark, sf):
    """Ranks whose stored ranges are gone when the result is read."""
    with scratch_scope(spark) as keep:
        return keep(rank_rows(table(spark, sf, "orders").select("o_orderkey", "o_orderdate"), ["o_orderdate"]))


# --- windows within groups -------------------------------------------------

FLAGGED = ["l_returnflag", "l_orderkey", "l_linenumber", "l_shipdate", "l_quantity"]


def flagged_lines(spark, sf):
    return table(spark, sf, "lineitem").select(*FLAGGED)


@query(
    "group_row_number",
    f"""SELECT {", ".join(FLAGGED)}, row_number() OVER (
            PARTITION BY l_returnflag ORDER BY l_shipdate, l_orderkey, l_linenumber, l_quantity) AS row_number
        FROM lineitem""",
)
def group_row_number(spark, sf):
    return number_rows(flagged_lines(spark, sf), ["l_shipdate"], groups=["l_returnflag"])


@query(
    "group_rank",
    f"""SELECT {", ".join(FLAGGED)}, rank() OVER (PARTITION BY l_returnflag ORDER BY l_shipdate DESC) AS rank FROM lineitem""",
)
def group_rank(spark, sf):
    lines = flagged_lines(spark, sf)
    return rank_rows(lines, [Key("l_shipdate", False)], groups=["l_returnflag"]).drop("dense_rank")


@query(
    "group_dense_rank",
    """SELECT l_returnflag, l_suppkey, l_quantity,
              dense_rank() OVER (PARTITION BY l_returnflag, l_suppkey ORDER BY l_quantity DESC) AS dense_rank FROM lineitem""",
)
def group_dense_rank(spark, sf):
    """Many small groups."""
    lines = table(spark, sf, "lineitem").select("l_returnflag", "l_suppkey", "l_quantity")
    return rank_rows(lines, [Key("l_quantity", False)], groups=["l_returnflag", "l_suppkey"]).drop("rank")


@query(
    "group_cumsum_rows",
    f"""SELECT {", ".join(FLAGGED)}, sum(l_quantity) OVER (
            PARTITION BY l_returnflag ORDER BY l_shipdate, l_orderkey, l_linenumber, l_quantity
            ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS quantity_so_far
        FROM lineitem""",
)
def group_cumsum_rows(spark, sf):
    return running_total(flagged_lines(spark, sf), "l_quantity", ["l_shipdate"], "quantity_so_far", groups=["l_returnflag"])


@query(
    "group_cumsum_range",
    f"""SELECT {", ".join(FLAGGED)},
            sum(l_quantity) OVER (PARTITION BY l_returnflag ORDER BY l_shipdate) AS quantity_so_far FROM lineitem""",
)
def group_cumsum_range(spark, sf):
    lines = flagged_lines(spark, sf)
    return running_total(lines, "l_quantity", ["l_shipdate"], "quantity_so_far", frame="range", groups=["l_returnflag"])


# --- sorting and sampling --------------------------------------------------


@query("sort_desc", "SELECT * FROM orders ORDER BY o_totalprice DESC")
def sort_desc(spark, sf):
    return sort_rows(table(spark, sf, "orders"), [Key("o_totalprice", ascending=False)])


@query("sort_asc", "SELECT * FROM orders ORDER BY o_totalprice")
def sort_asc(spark, sf):
    return sort_rows(table(spark, sf, "orders"), ["o_totalprice"])


@query("sort_multi", "SELECT * FROM part ORDER BY p_size DESC, p_retailprice DESC")
def sort_multi(spark, sf):
    return sort_rows(table(spark, sf, "part"), [Key("p_size", False), Key("p_retailprice", False)])


@query("sort_mixed", "SELECT * FROM lineitem ORDER BY l_quantity DESC, l_extendedprice")
def sort_mixed(spark, sf):
    """Descending, then ascending; column names are matched without case."""
    return sort_rows(table(spark, sf, "lineitem"), [Key("L_quantity", False), Key("l_Extendedprice")])


@query("top_k", f"SELECT * FROM lineitem ORDER BY {_line_order('l_extendedprice DESC')} LIMIT 10")
def top_k(spark, sf):
    lines = table(spark, sf, "lineitem")
    rest = [c for c in lines.columns if c != "l_extendedprice"]
    return lines.orderBy(F.col("l_extendedprice").desc(), *rest).limit(10)


@query(
    "sample_seeded",
    f"""SELECT * FROM lineitem
        WHERE substr(md5(concat_ws('|', '42', l_orderkey, l_linenumber)), 1, 8) < '{hash_bound(0.01)}'""",
)
def sample_seeded(spark, sf):
    """One in a hundred, the same rows for any partitioning."""
    return sample_by_hash(table(spark, sf, "lineitem"), 0.01, 42, ["l_orderkey", "l_linenumber"])


# --- set operations --------------------------------------------------------


@query(
    "union_positional",
    """SELECT CAST(c_custkey AS VARCHAR) AS id, c_name AS name FROM customer
       UNION ALL SELECT s_name, CAST(s_suppkey AS VARCHAR) FROM supplier""",
)
def union_positional(spark, sf):
    """By position: the second frame has its columns in another order, so its values change names."""
    customers = table(spark, sf, "customer").select(
        F.col("c_custkey").cast("string").alias("id"), F.col("c_name").alias("name")
    )
    suppliers = table(spark, sf, "supplier").select(
        F.col("s_name").alias("name"), F.col("s_suppkey").cast("string").alias("id")
    )
    return customers.union(suppliers)


@query(
    "union_by_name",
    """SELECT c_name AS name, CAST(c_custkey AS VARCHAR) AS id FROM customer
       UNION ALL SELECT s_name, CAST(s_suppkey AS VARCHAR) FROM supplier""",
)
def union_by_name(spark, sf):
    customers = table(spark, sf, "customer").select(
        F.col("c_name").alias("name"), F.col("c_custkey").cast("string").alias("id")
    )
    suppliers = table(spark, sf, "supplier").select(
        F.col("s_suppkey").cast("string").alias("id"), F.col("s_name").alias("name")
    )
    return customers.unionByName(suppliers)


@query(
    "union_missing_columns",
    """SELECT c_custkey AS id, c_name AS name, c_mktsegment AS segment, NULL::DOUBLE AS balance FROM customer
       UNION ALL SELECT s_suppkey, s_name, NULL, s_acctbal FROM supplier""",
)
def union_missing_columns(spark, sf):
    customers = table(spark, sf, "customer").select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment")
    )
    suppliers = table(spark, sf, "supplier").select(
        F.col("s_acctbal").alias("balance"), F.col("s_suppkey").alias("id"), F.col("s_name").alias("name")
    )
    return customers.unionByName(suppliers, allowMissingColumns=True)
