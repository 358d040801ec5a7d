"""Sharding by proportional stratified interleaving.

Rows are shuffled by a seeded key inside each source, each gets its fractional
rank there, and the whole table is ordered by that fraction: any stretch of it
then holds the sources in the proportions of the corpus. Cutting it into equal
stretches gives shards whose row counts differ by one at most.

Defined results: null sources form one source; null, empty and long texts are
rows like any other; repeated rows get places of their own (which copy gets
which is open); an empty table gives an empty table; columns named like a
result (`shard`, `slot`, and `position`, `total` in `interleave`) give way to
it, and so do `__position` and `__total`; maps and variants don't order rows. Rows of equal
or no ids are shuffled by all they hold, so places follow from the columns that are
passed. Equal texts are not kept together: the law that holds
is about row counts and the mixture.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripflow.llm.ranking import numbered_names, rank_in_groups, shuffle_key, shuffle_slot, slots_for, sortable
from tripflow.session import materialise, shuffle_parts

SEED = 20


def interleave(
    df: DataFrame, key: str, stratum: str, seed: int = SEED, position: str = "position", total: str = "total"
) -> DataFrame:
    """Adds the place of each row in the interleaved table, and the number of rows.

    The columns of `df` travel through two shuffles, so pass those that are
    wanted and no others. Three passes over stored rows, two shuffles; each
    task orders one cell of about `CELL_ROWS` rows.
    """
    df = df.drop(position, total)
    names, df = df.columns, numbered_names(df)
    key, stratum = (f"c{names.index(c)}" for c in (key, stratum))
    # Rows without an id, or of one id, are told apart by what they hold.
    rows_key = F.concat_ws(":", F.col(key).cast("string"), F.xxhash64(*sortable(df)).cast("string"))
    keyed = materialise(df.withColumn("__key", shuffle_key(seed, rows_key)))
    rows = keyed.count()
    slots = slots_for(rows)
    ties = ["__key", *[c for c in sortable(df) if c != stratum]]
    inside = rank_in_groups(
        keyed.withColumn("__slot", shuffle_slot(F.col("__key"), slots)), [stratum], "__slot", ties, rank="__rank"
    )
    sizes = keyed.groupBy(F.col(stratum).alias("__stratum")).agg(F.count(F.lit(1)).alias("__size"))
    fraction = (2 * F.col("__rank") + 1) / (2 * F.col("__size"))
    ranked = inside.join(sizes, inside[stratum].eqNullSafe(sizes["__stratum"])).drop("__stratum", "__slot")
    ranked = materialise(
        ranked.withColumn("__fraction", fraction)
        .withColumn("__slot", F.floor(F.col("__fraction") * slots).cast("int"))
        .drop("__rank", "__size")
    )
    order = ["__fraction", stratum, *ties]
    placed = rank_in_groups(ranked, [], "__slot", order, rank="__at")
    return placed.select(*df.columns, "__at", F.lit(rows).cast("long")).toDF(*names, position, total)


def cut(df: DataFrame, shards: int) -> DataFrame:
    """Turns `__position` and `__total` into `shard` and `slot`, the gapless place in the shard."""
    shard = f"__position * {shards}L div __total"
    first = F.expr(f"(({shard}) * __total + {shards}L - 1) div {shards}L")
    return df.select(
        *[f"`{c}`" for c in df.columns if c not in ("__position", "__total")],
        F.expr(shard).cast("int").alias("shard"),
        (F.col("__position") - first).cast("long").alias("slot"),
    )


def stratified_shards(df: DataFrame, shards: int, key: str = "doc_id", stratum: str = "source", seed: int = SEED) -> DataFrame:
    """Every row with its shard and its place there."""
    free = df.drop("shard", "slot")
    return cut(interleave(free, key, stratum, seed, "__position", "__total"), shards)


def write_shards(df: DataFrame, path: str) -> None:
    """One folder per shard; its files hold ranges of slots, rows in their order."""
    ranged = df.repartitionByRange(shuffle_parts(df.sparkSession), "shard", "slot")
    ranged.sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)

