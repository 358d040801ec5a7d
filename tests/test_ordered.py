import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tripflow.operators import (
    Key,
    collect_values,
    first_per_key,
    has_hot_group,
    number_rows,
    rank_rows,
    running_total,
    sort_rows,
    with_total,
)
from tripflow.operators import ordered


def rows_of(df):
    return sorted(map(repr, df.select(sorted(df.columns)).collect()))


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows share one key, a third are copies of one row; some keys and values are missing."""
    rng = random.Random(7)
    rows = [("hot", i % 50, float(i % 7)) for i in range(300)]
    rows += [("copy", 1, 2.0)] * 300
    rows += [(rng.choice(["a", "b", "c", None]), rng.randint(0, 20), rng.choice([None, 0.5, 1.25])) for _ in range(300)]
    rng.shuffle(rows)
    return spark.createDataFrame(rows, "k string, i int, v double").repartition(6).cache()


ORDERS = [["k"], [Key("k", False)], ["i", Key("k", False)], ["v"]]


def spark_order(df, order, ties=True):
    keys = [k if isinstance(k, Key) else Key(k) for k in order]
    rest = [F.col(c).asc() for c in df.columns if c not in {k.name for k in keys}] if ties else []
    return [k.column() for k in keys] + rest


@pytest.mark.parametrize("order", ORDERS, ids=str)
@pytest.mark.parametrize("hot_copies", [10, 1_000_000])
def test_number_rows(skewed, order, hot_copies):
    expected = skewed.withColumn("row_number", F.row_number().over(Window.orderBy(*spark_order(skewed, order))).cast("bigint"))
    got = number_rows(skewed, order, ranges=5, hot_copies=hot_copies, chunk=64)
    assert rows_of(got) == rows_of(expected)


@pytest.mark.parametrize("order", ORDERS, ids=str)
def test_rank_rows(skewed, order):
    window = Window.orderBy(*spark_order(skewed, order, ties=False))
    expected = skewed.withColumns(
        {"rank": F.rank().over(window).cast("bigint"), "dense_rank": F.dense_rank().over(window).cast("bigint")}
    )
    assert rows_of(rank_rows(skewed, order, ranges=5)) == rows_of(expected)


@pytest.mark.parametrize("order", ORDERS, ids=str)
@pytest.mark.parametrize("hot_copies", [10, 1_000_000])
def test_running_total_rows(skewed, order, hot_copies):
    window = Window.orderBy(*spark_order(skewed, order)).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    expected = skewed.withColumn("running_total", F.sum("v").over(window))
    got = running_total(skewed, "v", order, ranges=5, hot_copies=hot_copies, chunk=64)
    assert rows_of(got) == rows_of(expected)


@pytest.mark.parametrize("order", ORDERS, ids=str)
def test_running_total_range(skewed, order):
    expected = skewed.withColumn("running_total", F.sum("v").over(Window.orderBy(*spark_order(skewed, order, ties=False))))
    assert rows_of(running_total(skewed, "v", order, frame="range", ranges=5)) == rows_of(expected)


def test_rows_and_range_frames_differ_on_ties(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("b", 5)], "k string, v bigint")
    rows = running_total(df, "v", ["k"]).orderBy("k", "v").collect()
    peers = running_total(df, "v", ["k"], frame="range").orderBy("k", "v").collect()
    assert [r.running_total for r in rows] == [1, 3, 8]
    assert [r.running_total for r in peers] == [3, 3, 8]


def test_unknown_frame(skewed):
    with pytest.raises(ValueError):
        running_total(skewed, "v", ["k"], frame="groups")


def test_empty_input(spark):
    empty = spark.createDataFrame([], "k string, v double")
    assert number_rows(empty, ["k"]).collect() == []
    assert rank_rows(empty, ["k"]).collect() == []
    assert running_total(empty, "v", ["k"]).collect() == []
    assert with_total(empty, "v").collect() == []
    assert collect_values(empty, "k", "v", max_list=10).collect() == []
    assert sort_rows(empty, ["k"]).collect() == []


def test_hot_groups_are_found(spark, skewed):
    columns = skewed.columns
    assert has_hot_group(skewed, columns, 8, hot_rows=10)
    assert not has_hot_group(skewed, columns, 8, hot_rows=1000)
    assert not has_hot_group(skewed.dropDuplicates(), columns, 8, hot_rows=10)
    assert has_hot_group(skewed.dropDuplicates(), ["k"], 8, hot_rows=10)
    # One group just above an even share, among rows that are all different.
    many = spark.range(0, 200_000, 1, 4).withColumn("g", F.when(F.col("id") % 100 == 0, -1).otherwise(F.col("id")))
    assert has_hot_group(many, ["g"], 101, hot_rows=10)
    assert not has_hot_group(many, ["g"], 90, hot_rows=10)
    assert not has_hot_group(many, ["id"], 101, hot_rows=10)


def test_with_total(skewed):
    expected = skewed.agg(F.sum("v")).first()[0]
    assert {r.total for r in with_total(skewed, "v").collect()} == {expected}


@pytest.mark.parametrize("order", ORDERS, ids=str)
@pytest.mark.parametrize("hot_copies", [10, 1_000_000])
def test_sort_rows(skewed, order, hot_copies):
    expected = skewed.orderBy(*spark_order(skewed, order)).collect()
    assert sort_rows(skewed, order, ranges=5, hot_copies=hot_copies).collect() == expected


@pytest.mark.parametrize("max_list", [7, 1000])
def test_collect_values(skewed, max_list):
    lists = {}
    for row in skewed.collect():
        lists.setdefault(row.k, []).extend([] if row.i is None else [row.i])
    got = {}
    for row in collect_values(skewed, "k", "i", max_list=max_list).orderBy("k", "segment").collect():
        assert len(row["items"]) <= max_list
        got.setdefault(row.k, []).append(row["items"])
    assert {k: [v for part in parts for v in part] for k, parts in got.items()} == {
        k: sorted(values) for k, values in lists.items()
    }
    if max_list == 1000:
        assert all(len(parts) == 1 for parts in got.values())


def test_collect_values_leaves_out_nulls(spark):
    df = spark.createDataFrame([("a", None), ("a", 2), ("b", None), ("b", None)], "k string, v int")
    got = {(r.k, r.segment): r["items"] for r in collect_values(df, "k", "v", max_list=1).collect()}
    assert got == {("a", 0): [2], ("b", 0): []}


def test_first_per_key(skewed):
    window = Window.partitionBy("k").orderBy("i", "v")
    expected = skewed.withColumn("n", F.row_number().over(window)).filter("n = 1").drop("n")
    assert rows_of(first_per_key(skewed, ["k"], ["i"])) == rows_of(expected)


@pytest.mark.parametrize("kind", ["decimal(12,2)", "decimal(30,10)", "decimal(38,18)", "double", "int"])
@pytest.mark.parametrize("hot_copies", [2, 1_000_000])
def test_running_totals_keep_digits_and_type(spark, kind, hot_copies):
    rows = spark.range(40).selectExpr("id % 7 AS o", f"CAST(0.1234567891 * (id % 3) AS {kind}) AS v")
    plain = rows.selectExpr("o", "v", "SUM(v) OVER (ORDER BY o, v ROWS UNBOUNDED PRECEDING) AS running_total")
    own = running_total(rows, "v", ["o", "v"], "running_total", "rows", ranges=3, hot_copies=hot_copies)
    assert own.dtypes == plain.dtypes
    near = lambda df: sorted((r["o"], float(r["v"]), round(float(r["running_total"]), 9)) for r in df.collect())
    assert near(own) == near(plain)


def test_rows_with_maps(spark):
    rows = spark.range(30).select((F.col("id") % 4).alias("k"), "id", F.create_map(F.lit("a"), F.col("id")).alias("m"))
    assert sorted(r.row_number for r in number_rows(rows, ["k"]).collect()) == list(range(1, 31))
    assert [r.id for r in sort_rows(rows, ["k"]).collect()] == [r.id for r in rows.orderBy("k", "id").collect()]
    assert max(r.running_total for r in running_total(rows, "id", ["k"]).collect()) == 435


def test_copies_that_are_not_folded_spread_over_ranges(spark, monkeypatch):
    sizes, own = [], ordered._ranged

    def watched(*args):
        made = own(*args)
        sizes.append(max(r["count"] for r in made.groupBy(ordered.RANGE).count().collect()))
        return made

    monkeypatch.setattr(ordered, "_ranged", watched)
    maps = spark.range(0, 600, 1, 6).select(F.lit("k").alias("k"), F.create_map(F.lit("a"), F.lit(1)).alias("m"))
    got = number_rows(maps, ["k"], ranges=6, hot_copies=10)
    assert got.columns == ["k", "m", "row_number"] and sorted(r.row_number for r in got.collect()) == list(range(1, 601))
    wide = spark.range(0, 600, 1, 6).selectExpr("'k' AS k", "CAST(1 AS decimal(30,2)) AS v")
    totals = running_total(wide, "v", ["k"], ranges=6, hot_copies=10)
    assert totals.columns == ["k", "v", "running_total"] and sorted(int(r.running_total) for r in totals.collect()) == list(range(1, 601))
    assert sort_rows(maps, ["k"], ranges=6, hot_copies=10).columns == ["k", "m"]
    assert len(sizes) == 2 and max(sizes) < 300


GROUPS = [["k"], ["k", "i"], ["v"]]


@pytest.mark.parametrize("groups", GROUPS, ids=str)
@pytest.mark.parametrize("order", [["i"], [Key("v", False)], ["k", Key("v")]], ids=str)
@pytest.mark.parametrize("hot_copies", [10, 1_000_000])
def test_windows_within_groups(skewed, groups, order, hot_copies):
    """Hot groups span several ranges, small ones share a range; null is a group; numbers start again in each."""
    order = [k for k in order if (k.name if isinstance(k, Key) else k) not in groups] or ["i"]
    own = Window.partitionBy(*groups)
    all_keys = own.orderBy(*spark_order(skewed, order))
    peers = own.orderBy(*spark_order(skewed, order, ties=False))
    options = {"ranges": 5, "groups": groups}
    expected = skewed.withColumn("row_number", F.row_number().over(all_keys).cast("bigint"))
    assert rows_of(number_rows(skewed, order, hot_copies=hot_copies, chunk=64, **options)) == rows_of(expected)
    expected = skewed.withColumn("running_total", F.sum("v").over(all_keys.rowsBetween(Window.unboundedPreceding, 0)))
    assert rows_of(running_total(skewed, "v", order, hot_copies=hot_copies, chunk=64, **options)) == rows_of(expected)
    if hot_copies == 10:
        ranks = {"rank": F.rank().over(peers).cast("bigint"), "dense_rank": F.dense_rank().over(peers).cast("bigint")}
        assert rows_of(rank_rows(skewed, order, **options)) == rows_of(skewed.withColumns(ranks))
        expected = skewed.withColumn("running_total", F.sum("v").over(peers))
        assert rows_of(running_total(skewed, "v", order, frame="range", **options)) == rows_of(expected)


def test_one_group_spans_many_ranges(spark):
    rows = spark.range(4_000).select(F.lit("all").alias("g"), (F.col("id") * 7 % 4_001).alias("x"))
    got = number_rows(rows, ["x"], ranges=9, groups=["g"])
    assert [r.row_number for r in got.orderBy("x").collect()] == list(range(1, 4_001))
    assert number_rows(rows.limit(0), ["x"], groups=["g"]).count() == 0


def test_only_the_order_key_is_read_where_no_key_is_hot(spark, monkeypatch):
    looked = []
    real = ordered.has_hot_group
    monkeypatch.setattr(ordered, "has_hot_group", lambda df, columns, *a: looked.append(list(columns)) or real(df, columns, *a))
    rows = spark.range(100).select("id", F.lit("x").alias("wide"))
    sort_rows(rows, ["id"])
    number_rows(rows, ["id"], groups=["wide"])
    running_total(rows, "id", ["id"])
    assert looked == [["id"], ["wide", "id"], ["id"]]
