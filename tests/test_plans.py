"""What the physical plans must and must not contain."""

import re

import __spark_entry__ as contract
from tripflow.medallion import gold, silver
from tripflow.operators import collect_values, number_rows, rank_rows, running_total
from tripflow.plans.base import table
from tripflow.plans.medallion import yellow_trips
from tripflow.plans.trips import raw_green
from tripflow.sources import save

QUERIES = contract.queries()


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_projections_do_not_shuffle(spark, sf_dir):
    for name in ("gold_tips", "gold_performance", "gold_financials", "gold_classifications", "silver_yellow",
                 "zone_enrichment", "trip_events_json", "filter_conjunction"):
        assert "Exchange hashpartitioning" not in plan_of(QUERIES[name](spark, sf_dir)), name


def test_scan_is_pruned_and_filtered(spark, sf_dir):
    plan = plan_of(QUERIES["filter_conjunction"](spark, sf_dir))
    assert "EqualTo(l_returnflag,R)" in plan and "LessThan(l_quantity,10.0)" in plan
    assert "l_extendedprice" not in plan


def test_gate_reaches_the_raw_scan(spark, sf_dir, tmp_path):
    save(raw_green(spark, sf_dir), str(tmp_path / "green"))
    plan = plan_of(gold.tips(silver.green(spark.read.parquet(str(tmp_path / "green")))))
    for column in ("fare_amount", "tip_amount", "total_amount", "trip_distance", "tolls_amount"):
        assert f"GreaterThanOrEqual({column},0.0)" in plan
    assert "RatecodeID" not in plan and "trip_type" not in plan


def test_summaries_aggregate_before_the_shuffle(spark, sf_dir):
    for name in ("gold_fhv_summary", "gold_fhvhv_summary", "word_count", "pivot_avg", "dedup_by_key"):
        plan = plan_of(QUERIES[name](spark, sf_dir))
        assert "partial_" in plan[plan.rindex("Exchange"):], name


def test_top_k_keeps_k_rows_per_task(spark, sf_dir):
    assert "TakeOrderedAndProject" in plan_of(QUERIES["top_k"](spark, sf_dir))


def test_no_window_over_all_rows(spark, sf_dir):
    """A window in one task may only see one row per range."""
    lines = table(spark, sf_dir, "lineitem")
    for df in (
        number_rows(lines, ["l_shipdate"], ranges=4),
        number_rows(lines, ["l_shipdate"], ranges=4, hot_copies=0),
        rank_rows(lines, ["l_shipdate"], ranges=4),
        running_total(lines, "l_quantity", ["l_shipdate"], ranges=4),
        running_total(lines, "l_quantity", ["l_shipdate"], frame="range", ranges=4),
        collect_values(lines, "l_suppkey", "l_partkey", 100_000, ranges=4),
    ):
        plan = plan_of(df)
        inputs = re.findall(r"Exchange SinglePartition.*\n(.*)", plan)
        assert inputs and all("HashAggregate(keys=[__range" in i for i in inputs)


def test_gold_reads_its_own_columns_only(spark, sf_dir):
    plan = plan_of(gold.financials(yellow_trips(spark, sf_dir)))
    assert "l_returnflag" not in plan and "l_linestatus" not in plan
