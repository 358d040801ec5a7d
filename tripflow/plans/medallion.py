"""Schema drift, clean tables, published tables, and the whole pipeline."""

from __future__ import annotations

import functools
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampType

from tripflow.functions import elapsed_whole_minutes
from tripflow.medallion import gold, silver
from tripflow.medallion.pipeline import COMPACT, PipelineConfig, Step, run_pipeline
from tripflow.operators import align_and_union, column_histograms, detect_family, enrich_zones, read_drifting
from tripflow.plans import trips
from tripflow.operators.fingerprint import fingerprint
from tripflow.plans.base import ORACLES, half_up, query, table
from tripflow.plans.files import fresh_layer
from tripflow.session import scratch_path
from tripflow.sources import save


def zoneless(df: DataFrame) -> DataFrame:
    """Timestamps without a zone, as the oracle has them."""
    return df.withColumns(
        {f.name: F.col(f.name).cast("timestamp_ntz") for f in df.schema.fields if isinstance(f.dataType, TimestampType)}
    )


# --- schema drift ----------------------------------------------------------


@query(
    "schema_family",
    f"""SELECT CASE WHEN l_shipdate < TIMESTAMP '{trips.LEGACY_UNTIL}' THEN 'legacy'
                    WHEN l_shipdate < TIMESTAMP '{trips.INTERMEDIATE_UNTIL}' THEN 'intermediate'
                    ELSE 'modern' END AS family, count(*) AS n
        FROM lineitem GROUP BY 1""",
)
def schema_family(spark, sf):
    """Trips per family, the family told from the columns alone."""
    counts = [
        raw.agg(F.count("*").alias("n")).select(
            F.lit(detect_family(raw.columns, silver.YELLOW_FAMILIES, silver.YELLOW_DEFAULT_FAMILY)).alias("family"), "n"
        )
        for raw in trips.raw_families(spark, sf).values()
    ]
    return functools.reduce(DataFrame.unionByName, counts)


def drifting_lines(spark, sf) -> list[DataFrame]:
    """Three periods of lineitem whose columns differ in type, spelling and presence."""
    lines, day = table(spark, sf, "lineitem"), F.col("l_shipdate")
    first, second = (F.lit(d).cast("timestamp_ntz") for d in (trips.LEGACY_UNTIL, trips.INTERMEDIATE_UNTIL))
    return [
        lines.filter(day < first).selectExpr(
            "l_orderkey", "CAST(l_quantity AS INT) AS l_quantity", "l_linenumber", "l_tax AS Airport_fee", "l_suppkey AS code"
        ),
        lines.filter((day >= first) & (day < second)).selectExpr(
            "l_orderkey", "l_quantity", "CAST(l_linenumber AS BIGINT) AS l_linenumber", "l_tax AS airport_fee",
            "concat('S', l_suppkey) AS code",
        ),
        lines.filter(day >= second).selectExpr("CAST(l_orderkey AS INT) AS l_orderkey", "l_quantity", "l_returnflag"),
    ]


DRIFT_SQL = f"""
    SELECT CAST(l_orderkey AS DOUBLE) AS l_orderkey, l_quantity,
           CASE WHEN l_shipdate < TIMESTAMP '{trips.INTERMEDIATE_UNTIL}' THEN CAST(l_linenumber AS DOUBLE) END AS l_linenumber,
           CASE WHEN l_shipdate < TIMESTAMP '{trips.INTERMEDIATE_UNTIL}' THEN l_tax END AS Airport_fee,
           CASE WHEN l_shipdate < TIMESTAMP '{trips.LEGACY_UNTIL}' THEN CAST(l_suppkey AS VARCHAR)
                WHEN l_shipdate < TIMESTAMP '{trips.INTERMEDIATE_UNTIL}' THEN concat('S', l_suppkey) END AS code,
           CASE WHEN l_shipdate >= TIMESTAMP '{trips.INTERMEDIATE_UNTIL}' THEN l_returnflag END AS l_returnflag
    FROM lineitem"""


@query("schema_drift_union", DRIFT_SQL)
def schema_drift_union(spark, sf):
    """Through files: schemas read once, one scan per schema."""
    base = scratch_path(spark, "drift")
    paths = [f"{base}/part{i}" for i in range(3)]
    for path, part in zip(paths, drifting_lines(spark, sf)):
        save(part, path)
    return read_drifting(spark, paths)


@query("schema_drift_frames", DRIFT_SQL)
def schema_drift_frames(spark, sf):
    return align_and_union(drifting_lines(spark, sf))


# --- clean tables ----------------------------------------------------------


def yellow_trips(spark, sf) -> DataFrame:
    """All trips as modern yellow ones, cleaned: the input of the published tables."""
    return silver.yellow({"modern": trips.raw_modern(spark, sf)})


@query("silver_yellow", trips.YELLOW_FAMILIES_SQL)
def silver_yellow(spark, sf):
    return zoneless(silver.yellow(trips.raw_families(spark, sf)))


@query("silver_green", trips.GREEN_SQL)
def silver_green(spark, sf):
    return zoneless(silver.green(trips.raw_green(spark, sf)))


@query("silver_fhv", trips.FHV_SQL)
def silver_fhv(spark, sf):
    return zoneless(silver.fhv(trips.raw_fhv(spark, sf)))


@query("silver_fhvhv", trips.FHVHV_SQL)
def silver_fhvhv(spark, sf):
    return zoneless(silver.fhvhv(trips.raw_fhvhv(spark, sf)))


ZONES_SQL = """SELECT n_nationkey AS LocationID, r_name AS Borough, n_name AS Zone, 'Boro Zone' AS service_zone
               FROM nation JOIN region ON n_regionkey = r_regionkey"""


def zones(spark, sf) -> DataFrame:
    joined = table(spark, sf, "nation").join(table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    return joined.select(
        F.col("n_nationkey").alias("LocationID"),
        F.col("r_name").alias("Borough"),
        F.col("n_name").alias("Zone"),
        F.lit("Boro Zone").alias("service_zone"),
    )


def _with_zones_sql(trips_sql: str) -> str:
    return f"""WITH zones AS ({ZONES_SQL})
        SELECT t.*, pu.Borough AS PUBorough, pu.Zone AS PUZone, pu.service_zone AS PUservice_zone,
               d.Borough AS DOBorough, d.Zone AS DOZone, d.service_zone AS DOservice_zone
        FROM ({trips_sql}) t LEFT JOIN zones pu ON PULocationID = pu.LocationID
             LEFT JOIN zones d ON DOLocationID = d.LocationID"""


@query(
    "zone_enrichment",
    _with_zones_sql(
        f'SELECT vendor AS VendorID, pu AS PULocationID, "do" AS DOLocationID, total AS total_amount '
        f"FROM ({trips.TRIPS_SQL})"
    ),
)
def zone_enrichment(spark, sf):
    raw = trips.raw_modern(spark, sf).select("VendorID", "PULocationID", "DOLocationID", "total_amount")
    roles = {"PU": "PULocationID", "DO": "DOLocationID"}
    return enrich_zones(raw, zones(spark, sf), "LocationID", roles, silver.ZONE_ATTRIBUTES)


@query("silver_enriched", _with_zones_sql(trips.SINGLE_SQL))
def silver_enriched(spark, sf):
    return zoneless(silver.single_dataset(trips.raw_modern(spark, sf), zones(spark, sf)))


# --- published tables ------------------------------------------------------

RATIO_SQL = "CASE WHEN fare_amount > 0 THEN tip_amount / fare_amount ELSE 0 END"
TIPS_COLUMNS = f"""vendor_id, pickup_datetime, tip_amount, fare_amount, {half_up(RATIO_SQL)} AS tip_ratio,
                   tip_amount > 0 AS is_tipped"""


@query("gold_tips", f"SELECT {TIPS_COLUMNS} FROM ({trips.YELLOW_MODERN_SQL})")
def gold_tips(spark, sf):
    return zoneless(gold.tips(yellow_trips(spark, sf)))


@query("gold_tips_green", f"SELECT {TIPS_COLUMNS} FROM ({trips.GREEN_SQL})")
def gold_tips_green(spark, sf):
    return zoneless(gold.tips(silver.green(trips.raw_green(spark, sf))))


SINGLE_KEYS = ("VendorID", "tpep_pickup_datetime")
# Older tables work on the raw layout and whole minutes.
SINGLE_TRIPS_SQL = f"""SELECT * REPLACE (date_sub('minute', tpep_pickup_datetime, tpep_dropoff_datetime)
                       AS trip_duration_minutes) FROM ({trips.SINGLE_SQL})"""


def single_trips(spark, sf) -> DataFrame:
    return silver.single_dataset(trips.raw_modern(spark, sf), zones(spark, sf)).withColumn(
        "trip_duration_minutes", elapsed_whole_minutes("tpep_pickup_datetime", "tpep_dropoff_datetime")
    )


@query(
    "gold_extreme_tip",
    f"""SELECT VendorID, tpep_pickup_datetime, tip_amount, fare_amount, {half_up(RATIO_SQL)} AS tip_ratio,
               tip_amount > 0 AS is_tipped, {RATIO_SQL} > 1 AS is_extreme_tip
        FROM ({SINGLE_TRIPS_SQL})""",
)
def gold_extreme_tip(spark, sf):
    return zoneless(gold.tips_with_extremes(single_trips(spark, sf), SINGLE_KEYS))


def _performance_sql(keys: str, source: str) -> str:
    speed = "CASE WHEN trip_duration_minutes > 0 THEN trip_distance / (trip_duration_minutes / 60e0) ELSE 0 END"
    revenue = "CASE WHEN trip_duration_minutes > 0 THEN total_amount / trip_duration_minutes ELSE 0 END"
    return f"""SELECT {keys}, trip_distance, trip_duration_minutes, {half_up(speed)} AS avg_speed_mph,
                      {half_up(revenue)} AS revenue_per_minute FROM ({source})"""


@query("gold_performance", _performance_sql("vendor_id, pickup_datetime", trips.YELLOW_MODERN_SQL))
def gold_performance(spark, sf):
    return zoneless(gold.performance(yellow_trips(spark, sf)))


@query("gold_performance_green", _performance_sql("vendor_id, pickup_datetime", trips.GREEN_SQL))
def gold_performance_green(spark, sf):
    return zoneless(gold.performance(silver.green(trips.raw_green(spark, sf))))


@query("gold_performance_whole_minutes", _performance_sql("VendorID, tpep_pickup_datetime", SINGLE_TRIPS_SQL))
def gold_performance_whole_minutes(spark, sf):
    return zoneless(gold.performance(single_trips(spark, sf), SINGLE_KEYS))


def _financials_sql(keys: str, fees: tuple[str, ...], source: str) -> str:
    mile = "CASE WHEN trip_distance > 0 THEN total_amount / trip_distance ELSE 0 END"
    head = "CASE WHEN passenger_count > 0 THEN total_amount / passenger_count ELSE 0 END"
    return f"""SELECT {keys}, {half_up(" + ".join(fees))} AS total_fees, total_amount,
                      {half_up(mile)} AS cost_per_mile, {half_up(head)} AS fare_per_passenger FROM ({source})"""


@query("gold_financials", _financials_sql("vendor_id, pickup_datetime", gold.YELLOW_FEES, trips.YELLOW_MODERN_SQL))
def gold_financials(spark, sf):
    return zoneless(gold.financials(yellow_trips(spark, sf)))


@query("gold_financials_green", _financials_sql("vendor_id, pickup_datetime", gold.GREEN_FEES, trips.GREEN_SQL))
def gold_financials_green(spark, sf):
    return zoneless(gold.financials(silver.green(trips.raw_green(spark, sf)), gold.GREEN_FEES))


@query("gold_financials_7fee", _financials_sql("VendorID, tpep_pickup_datetime", gold.SINGLE_FEES, SINGLE_TRIPS_SQL))
def gold_financials_7fee(spark, sf):
    return zoneless(gold.financials(single_trips(spark, sf), gold.SINGLE_FEES, SINGLE_KEYS))


def _classifications_sql(keys: tuple[str, str], codes: str, source: str) -> str:
    return f"""SELECT {", ".join(keys)},
                      hour({keys[1]}) BETWEEN 7 AND 9 OR hour({keys[1]}) BETWEEN 16 AND 19 AS is_peak_hour,
                      dayofweek({keys[1]}) IN (0, 6) AS is_weekend,
                      CASE WHEN trip_distance < 2 THEN 'short' WHEN trip_distance < 10 THEN 'medium'
                           ELSE 'long' END AS trip_type,
                      CAST(payment_type AS VARCHAR) IN ({codes}) AS is_card_payment,
                      trip_distance <= 0 OR fare_amount <= 0 OR trip_duration_minutes <= 0 AS is_suspicious
               FROM ({source})"""


@query(
    "gold_classifications",
    _classifications_sql(gold.KEYS, "'CRD', 'CRE', '1'", trips.YELLOW_FAMILIES_SQL),
)
def gold_classifications(spark, sf):
    return zoneless(gold.classifications(silver.yellow(trips.raw_families(spark, sf))))


@query("gold_classifications_green", _classifications_sql(gold.KEYS, "'1'", trips.GREEN_SQL))
def gold_classifications_green(spark, sf):
    return zoneless(gold.classifications(silver.green(trips.raw_green(spark, sf)), gold.GREEN_CARD_CODES))


@query("gold_classifications_single", _classifications_sql(SINGLE_KEYS, "'1'", SINGLE_TRIPS_SQL))
def gold_classifications_single(spark, sf):
    return zoneless(gold.classifications(single_trips(spark, sf), gold.GREEN_CARD_CODES, SINGLE_KEYS, SINGLE_KEYS[1]))


@query(
    "gold_fhv_summary",
    f"""SELECT dispatching_base_num, count(*) AS trip_count, round(sum(trip_duration_minutes), 2) AS total_trip_minutes,
               CAST(sum(CASE WHEN sr_flag IS NOT NULL THEN 1 ELSE 0 END) AS BIGINT) AS sr_flag_trip_count
        FROM ({trips.FHV_SQL}) GROUP BY dispatching_base_num""",
)
def gold_fhv_summary(spark, sf):
    return gold.fhv_summary(silver.fhv(trips.raw_fhv(spark, sf)))


@query(
    "gold_fhvhv_summary",
    f"""SELECT hvfhs_license_num, count(*) AS trip_count, round(sum(trip_miles), 2) AS total_trip_miles,
               round(sum(base_passenger_fare), 2) AS total_base_passenger_fare, round(sum(tips), 2) AS total_tips,
               round(sum(driver_pay), 2) AS total_driver_pay
        FROM ({trips.FHVHV_SQL}) GROUP BY hvfhs_license_num""",
)
def gold_fhvhv_summary(spark, sf):
    return gold.fhvhv_summary(silver.fhvhv(trips.raw_fhvhv(spark, sf)))


# --- profile ---------------------------------------------------------------

HISTOGRAM_COLUMNS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_linenumber", "l_suppkey"]


@query(
    "histogram_50",
    f"""WITH cells AS (
            UNPIVOT (SELECT {", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in HISTOGRAM_COLUMNS)} FROM lineitem)
            ON {", ".join(HISTOGRAM_COLUMNS)} INTO NAME "column" VALUE v),
        bounds AS (SELECT "column", min(v) AS lo, max(v) AS hi FROM cells GROUP BY "column"),
        near AS (
            SELECT "column", v, lo, (hi - lo) / 50 AS step, floor((v - lo) / (hi - lo) * 50) AS b
            FROM cells JOIN bounds USING ("column")),
        counts AS (
            SELECT "column", CAST(least(CASE WHEN v < lo + b * step THEN b - 1
                                             WHEN v >= lo + (b + 1) * step THEN b + 1 ELSE b END, 49) AS INTEGER) AS bin,
                   count(*) AS n
            FROM near GROUP BY 1, 2),
        slots AS (SELECT "column", lo, hi, CAST(unnest(range(50)) AS INTEGER) AS bin FROM bounds)
        SELECT "column", bin, lo + bin * ((hi - lo) / 50) AS low,
               CASE WHEN bin = 49 THEN hi ELSE lo + (bin + 1) * ((hi - lo) / 50) END AS high, coalesce(n, 0) AS n
        FROM slots LEFT JOIN counts USING ("column", bin)""",
)
def histogram_50(spark, sf):
    return column_histograms(table(spark, sf, "lineitem"), HISTOGRAM_COLUMNS)


SPREAD_COLUMNS = "o_orderkey o_custkey o_totalprice".split()


@query(
    "numeric_spread",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", CAST(min({c}) AS DOUBLE) AS low, CAST(max({c}) AS DOUBLE) AS high, count({c}) AS n FROM orders"""
        for c in SPREAD_COLUMNS
    ),
)
def numeric_spread(spark, sf):
    """Extremes and counts of all columns that hold numbers, found by their types, from the cells of histograms."""
    cells = column_histograms(table(spark, sf, "orders"), bins=4)
    return cells.groupBy("column").agg(F.min("low").alias("low"), F.max("high").alias("high"), F.sum("n").alias("n"))


# --- the whole pipeline ----------------------------------------------------


def _count_sql(layer: str, name: str, source: str) -> str:
    return f"SELECT '{layer}' AS layer, '{name}' AS name, 'written' AS status, count(*) AS n FROM ({source})"


def _run_sql() -> str:
    gold_sources = {
        **dict.fromkeys(gold.YELLOW_TABLES, trips.YELLOW_FAMILIES_SQL),
        **dict.fromkeys(gold.GREEN_TABLES, trips.GREEN_SQL),
        "fhvhv_trip_summary": f"SELECT DISTINCT hvfhs_license_num FROM ({trips.FHVHV_SQL})",
    }
    parts = [
        _count_sql("silver", "yellow_taxi", trips.YELLOW_FAMILIES_SQL),
        _count_sql("silver", "green_taxi", trips.GREEN_SQL),
        _count_sql("silver", "fhvhv_trip", trips.FHVHV_SQL),
        *(_count_sql("gold", name, source) for name, source in gold_sources.items()),
        "SELECT 'silver', 'fhv_trip', 'skipped', 0",
        "SELECT 'gold', 'fhv_trip_summary', 'skipped', 0",
    ]
    return " UNION ALL ".join(parts)


def _print_sql(layer: str, name: str, source: str, kinds: dict[str, str]) -> str:
    """SQL for the fingerprint of a table whose columns have the given types."""

    def told(c: str) -> str:
        value = f'"{c}"'
        if kinds[c] in ("double", "float"):
            value = f"CAST(round({value} * 1000) AS BIGINT)"
        elif kinds[c].startswith("timestamp"):
            value = f"strftime({value}, '%Y-%m-%d %H:%M:%S')"
        return f"coalesce('=' || CAST({value} AS VARCHAR), '-')"

    row = ", ".join(told(c) for c in sorted(kinds, key=str.lower))
    return f"""SELECT '{layer}' AS layer, '{name}' AS name, count(*) AS n,
        CAST(coalesce(sum(CAST('0x' || substr(md5(concat_ws('|', {row})), 1, 12) AS BIGINT)), 0) AS VARCHAR) AS fingerprint
        FROM ({source})"""


PRINTED = {
    "orders": {
        "o_orderkey": "bigint", "o_custkey": "bigint", "o_orderstatus": "string", "o_totalprice": "double", "o_orderdate": "timestamp",
        "o_orderpriority": "string",
    },
    "customer": {"c_custkey": "bigint", "c_name": "string", "c_nationkey": "int", "c_acctbal": "double", "c_mktsegment": "string"},
}


@query("table_fingerprint", " UNION ALL ".join(_print_sql("raw", name, name, kinds) for name, kinds in PRINTED.items()))
def table_fingerprint(spark, sf):
    """Rows and fingerprints of tables, whatever the order of their rows."""
    found = (
        fingerprint(table(spark, sf, name).select(*kinds).repartition(3)).select(F.lit("raw").alias("layer"), F.lit(name).alias("name"), "*")
        for name, kinds in PRINTED.items()
    )
    return functools.reduce(DataFrame.unionByName, found)


def write_raw_trips(spark, sf, directory: str) -> None:
    """Raw files of three of the four datasets, yellow in its three families, written side by side."""
    raw = {f"yellow_tripdata_{family}": df for family, df in trips.raw_families(spark, sf).items()}
    raw |= {"green_tripdata_all": trips.raw_green(spark, sf), "fhvhv_tripdata_all": trips.raw_fhvhv(spark, sf)}
    with ThreadPoolExecutor(len(raw)) as pool:
        list(pool.map(lambda name: save(raw[name], f"{directory}/{name}.parquet", **COMPACT), raw))


def _finished_run(spark, sf, **options) -> tuple[list[Step], dict[str, str]]:
    """Runs the pipeline over raw files; its steps but for the checks of raw files, and the namespaces of its layers."""
    raw = scratch_path(spark, "raw")
    write_raw_trips(spark, sf, raw)
    cfg = PipelineConfig(raw, fresh_layer(spark, "silver"), fresh_layer(spark, "gold"), keep_raw=False, **options)
    return [step for step in run_pipeline(spark, cfg) if step.layer != "bronze"], {"silver": cfg.silver, "gold": cfg.gold}


@query("medallion_run", _run_sql())
def medallion_run(spark, sf):
    """Rows per table after a run; the dataset without raw files is skipped."""
    steps, layers = _finished_run(spark, sf)

    def outcome(step):
        told = [F.lit(v).alias(c) for c, v in (("layer", step.layer), ("name", step.table), ("status", step.status))]
        if step.status == "skipped":
            return spark.range(1).select(*told, F.lit(0).cast("bigint").alias("n"))
        return spark.table(f"{layers[step.layer]}.{step.table}").agg(F.count("*").alias("n")).select(*told, "n")

    return functools.reduce(DataFrame.unionByName, map(outcome, steps))


# Columns of the tables that a run writes and that are told as they are; times end in _datetime, all others hold fractions.
PLAIN = frozenset(
    """vendor_id passenger_count payment_type rate_code store_and_fwd_flag pu_location_id do_location_id hvfhs_license_num
    dispatching_base_num originating_base_num trip_time_seconds shared_request_flag shared_match_flag access_a_ride_flag
    wav_request_flag wav_match_flag is_tipped is_peak_hour is_weekend trip_type is_card_payment is_suspicious trip_count""".split()
)
KEY_COLUMNS = "vendor_id pickup_datetime"
TAXI_COLUMNS = f"""{KEY_COLUMNS} dropoff_datetime passenger_count trip_distance payment_type fare_amount tip_amount tolls_amount
    total_amount mta_tax rate_code store_and_fwd_flag trip_duration_minutes"""
TIP_COLUMNS = f"{KEY_COLUMNS} tip_amount fare_amount tip_ratio is_tipped"
PERFORMANCE_COLUMNS = f"{KEY_COLUMNS} trip_distance trip_duration_minutes avg_speed_mph revenue_per_minute"
FINANCIAL_COLUMNS = f"{KEY_COLUMNS} total_fees total_amount cost_per_mile fare_per_passenger"
CLASS_COLUMNS = f"{KEY_COLUMNS} is_peak_hour is_weekend trip_type is_card_payment is_suspicious"


def _taxi_gold(color: str, source: str, fees: tuple[str, ...], codes: str) -> list[tuple[str, str, str, str]]:
    keys = ", ".join(gold.KEYS)
    return [
        ("gold", f"{color}_taxi_tips", TIP_COLUMNS, f"SELECT {TIPS_COLUMNS} FROM ({source})"),
        ("gold", f"{color}_taxi_performance", PERFORMANCE_COLUMNS, _performance_sql(keys, source)),
        ("gold", f"{color}_taxi_financials", FINANCIAL_COLUMNS, _financials_sql(keys, fees, source)),
        ("gold", f"{color}_taxi_classifications", CLASS_COLUMNS, _classifications_sql(gold.KEYS, codes, source)),
    ]


# Layer, table, columns and SQL of every table that a run writes.
WRITTEN = [
    ("silver", "yellow_taxi", f"{TAXI_COLUMNS} surcharge pickup_longitude pickup_latitude dropoff_longitude dropoff_latitude",
     trips.YELLOW_FAMILIES_SQL),
    ("silver", "green_taxi", f"{TAXI_COLUMNS} extra improvement_surcharge pu_location_id do_location_id trip_type_raw", trips.GREEN_SQL),
    ("silver", "fhvhv_trip", """hvfhs_license_num dispatching_base_num originating_base_num request_datetime on_scene_datetime
     pickup_datetime dropoff_datetime pu_location_id do_location_id trip_miles trip_time_seconds base_passenger_fare tolls bcf
     sales_tax congestion_surcharge airport_fee tips driver_pay shared_request_flag shared_match_flag access_a_ride_flag
     wav_request_flag wav_match_flag trip_duration_minutes""", trips.FHVHV_SQL),
    *_taxi_gold("yellow", trips.YELLOW_FAMILIES_SQL, gold.YELLOW_FEES, "'CRD', 'CRE', '1'"),
    *_taxi_gold("green", trips.GREEN_SQL, gold.GREEN_FEES, "'1'"),
    ("gold", "fhvhv_trip_summary", """hvfhs_license_num trip_count total_trip_miles total_base_passenger_fare total_tips
     total_driver_pay""", ORACLES["gold_fhvhv_summary"]),
]


def _kinds(columns: str) -> dict[str, str]:
    """Types by the rule above `PLAIN`."""
    return {c: "timestamp" if c.endswith("_datetime") else "string" if c in PLAIN else "double" for c in columns.split()}


PRINTS_SQL = " UNION ALL ".join(_print_sql(layer, name, source, _kinds(columns)) for layer, name, columns, source in WRITTEN)


def _prints(spark, sf, **options) -> DataFrame:
    steps, layers = _finished_run(spark, sf, **options)
    found = (
        fingerprint(spark.table(f"{layers[step.layer]}.{step.table}")).select(
            F.lit(step.layer).alias("layer"), F.lit(step.table).alias("name"), "*"
        )
        for step in steps
        if step.status == "written"
    )
    return functools.reduce(DataFrame.unionByName, found)


@query("medallion_fingerprints", PRINTS_SQL)
def medallion_fingerprints(spark, sf):
    """Rows and fingerprints of every value in every table that a run writes."""
    return _prints(spark, sf)


@query("medallion_fingerprints_clustered", PRINTS_SQL)
def medallion_fingerprints_clustered(spark, sf):
    """The same with published tables in files of a stated number of rows, ranged by pickup time."""
    return _prints(spark, sf, rows_per_file=100_000)


@query("medallion_fingerprints_reused", PRINTS_SQL)
def medallion_fingerprints_reused(spark, sf):
    """The same with clean tables kept in memory between the tables derived from them."""
    return _prints(spark, sf, reuse_silver=True)
