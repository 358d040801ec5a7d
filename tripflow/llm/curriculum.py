"""Mixing sources to target weights by a curriculum that varies over time.

Each source has a piecewise linear weight schedule over the training time 0 to
1. Its integral is the source's share of the mixture; a share above
`max_repeats` times the source's own words is cut there and the excess is
shared again by weight. A source hands out its documents in a seeded order,
once per pass, until the words taken reach its target; the time at which the
cumulative demand of its schedule reaches a document is that document's
training position, and the mixture is the table ordered by position.

Only Spark's own functions run. A source of any size is ranked in cells
(`ranking.rank_in_groups`), so a hot one is no task's burden.

Defined results: words are counted in null text as none, and documents without
words are never taken; null sources are one source, the last; rows equal in
id, source and size share one decision; ties in position are broken by source,
id and pass; an empty table gives an empty table; further columns are kept, and
working names begin with two underscores.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripflow.llm.quality import bind, words_of
from tripflow.llm.ranking import numbered_names, rank_in_groups, shuffle_key, shuffle_slot, slots_for
from tripflow.session import materialise, shuffle_parts

# Knots (time, weight); dealt to the sources in turn. Their integrals are 3, 1 and 2.
SCHEDULES = (((0.0, 4.0), (1.0, 2.0)), ((0.0, 1.0), (1.0, 1.0)), ((0.0, 1.0), (1.0, 3.0)))
BUDGET = 1.5
MAX_REPEATS = 2
SEED = 50

Knots = Sequence[tuple[float, float]]


def integral(knots: Knots) -> float:
    return sum((a[1] + b[1]) / 2 * (b[0] - a[0]) for a, b in zip(knots, knots[1:]))


def word_count(text: Column) -> Column:
    return bind(words_of(text), lambda w: F.when(F.get(w, F.lit(0)) == "", F.lit(0)).otherwise(F.size(w))).cast("long")


def targets(
    sources: DataFrame, schedules: Sequence[Knots] = SCHEDULES, budget: float = BUDGET, max_repeats: int = MAX_REPEATS
) -> DataFrame:
    """Per source its schedule's number, weight and target, from (source, source_size).

    Sources are few beside documents: one row each. Those that reach their
    bound are found in the order of bound over weight: a source is cut if the
    words left, shared among it and all later ones, would pass its bound.
    """
    everything = Window.partitionBy()
    by_name = everything.orderBy(F.col("source").asc_nulls_last())
    weights = F.array(*[F.lit(float(integral(k))) for k in schedules])
    base = (
        sources.withColumn("schedule", ((F.row_number().over(by_name) - 1) % len(schedules)).cast("int"))
        .withColumn("weight", F.get(weights, F.col("schedule")))
        .withColumn("bound", F.lit(max_repeats) * F.col("source_size"))
    )
    by_bound = everything.orderBy(F.col("bound") / F.col("weight"), F.col("source").asc_nulls_last())
    earlier = by_bound.rowsBetween(Window.unboundedPreceding, -1)
    later = by_bound.rowsBetween(0, Window.unboundedFollowing)
    total = F.lit(budget) * F.sum("source_size").over(everything)
    left = total - F.coalesce(F.sum("bound").over(earlier), F.lit(0))
    cut = base.withColumn("cut", left / F.sum("weight").over(later) >= F.col("bound") / F.col("weight"))
    rest = total - F.coalesce(F.sum(F.when(F.col("cut"), F.col("bound"))).over(everything), F.lit(0))
    free = F.sum(F.when(~F.col("cut"), F.col("weight"))).over(everything)
    target = F.when(F.col("cut"), F.col("bound").cast("double")).otherwise(F.col("weight") * rest / free)
    return cut.select("source", "source_size", "schedule", "weight", target.cast("double").alias("target"))


def position(schedules: Sequence[Knots], schedule: Column, share: Column) -> Column:
    """The time at which a schedule has handed out `share` (0 to 1) of its integral."""
    kind = "array<array<struct<t:double,w:double,slope:double,done:double>>>"
    rows = []
    for knots in schedules:
        done, parts = 0.0, []
        for (t0, w0), (t1, w1) in zip(knots, knots[1:]):
            parts.append(F.struct(*[F.lit(float(v)) for v in (t0, w0, (w1 - w0) / (t1 - t0), done)]))
            done += (w0 + w1) / 2 * (t1 - t0)
        rows.append(F.array(*parts))
    table = F.array(*rows).cast(kind)
    whole = F.get(F.array(*[F.lit(float(integral(k))) for k in schedules]), schedule)

    def within(part: Column) -> Column:
        rest = share * whole - part["done"]
        root = part["w"] + F.sqrt(F.greatest(part["w"] * part["w"] + 2 * part["slope"] * rest, F.lit(0.0)))
        return part["t"] + F.when(root > 0, 2 * rest / root).otherwise(F.lit(0.0))

    started = F.filter(F.get(table, schedule), lambda p: p["done"] <= share * whole)
    return bind(F.element_at(started, -1), within)


def plan_mixture(
    sized: DataFrame,
    schedules: Sequence[Knots] = SCHEDULES,
    budget: float = BUDGET,
    max_repeats: int = MAX_REPEATS,
    seed: int = SEED,
) -> DataFrame:
    """From (doc_id, source, size): how often each document is taken, and where in training.

    Rows equal in all three are one row here, with their number in `rows`.

    A pass over a source hands out its documents in the order of a seeded key;
    a document is taken in a pass if the middle of its words lies within the
    target, so a source misses its target by half a document at most.
    """
    units = materialise(
        sized.groupBy("doc_id", "source", "size")
        .agg(F.count(F.lit(1)).alias("rows"))
        .withColumn("words", F.col("size") * F.col("rows"))
        .withColumn("key", shuffle_key(seed, F.col("doc_id")))
    )
    shares = materialise(
        targets(
            units.groupBy("source").agg(F.sum("words").alias("source_size")), schedules, budget, max_repeats
        ).coalesce(1)
    )
    slots = slots_for(units.count())
    ranked = rank_in_groups(
        units.withColumn("slot", shuffle_slot(F.col("key"), slots)),
        ["source"], "slot", ["key", "doc_id", "size"], value="words",
    )
    of = shares.withColumnRenamed("source", "named")
    joined = ranked.join(of, ranked["source"].eqNullSafe(of["named"])).drop("named")
    middle = F.col("before") + F.col("words") / 2
    passes = F.floor((F.col("target") - middle) / F.col("source_size")) + 1
    copies = F.when(F.col("words") > 0, F.least(F.greatest(passes, F.lit(0)), F.lit(max_repeats))).otherwise(F.lit(0))
    share = lambda p: (middle + p * F.col("source_size")) / F.col("target")
    places = F.when(
        F.col("copies") > 0,
        F.transform(
            F.sequence(F.lit(0), F.col("copies") - 1), lambda p: position(schedules, F.col("schedule"), share(p))
        ),
    ).otherwise(F.array().cast("array<double>"))
    return (
        joined.withColumn("copies", copies.cast("int"))
        .withColumn("positions", places)
        .select("doc_id", "source", "size", "rows", "source_size", "target", "copies", "positions")
    )


def by_position(df: DataFrame, at: str, ties: Sequence[str]) -> DataFrame:
    """Rows in ranges of position, one range per partition; rows without one are spread and end each partition."""
    parts = shuffle_parts(df.sparkSession)
    ranged = F.least(F.floor(F.col(at) * parts), F.lit(parts - 1))
    place = F.when(F.col(at).isNotNull(), ranged).otherwise(F.pmod(F.xxhash64(*ties), F.lit(parts))).cast("int")
    return df.repartitionById(parts, place).sortWithinPartitions(F.col(at).asc_nulls_last(), *ties)


def mix(
    docs: DataFrame,
    schedules: Sequence[Knots] = SCHEDULES,
    budget: float = BUDGET,
    max_repeats: int = MAX_REPEATS,
    seed: int = SEED,
) -> DataFrame:
    """The mixture: each document once per pass that takes it, in training order, with its own columns."""
    names, docs = docs.columns, numbered_names(docs)
    doc_id, source, text = (f"c{names.index(c)}" for c in ("doc_id", "source", "text"))
    sized = docs.withColumn("__size", word_count(F.col(text)))
    narrow = sized.select(F.col(doc_id).alias("doc_id"), F.col(source).alias("source"), F.col("__size").alias("size"))
    plan = plan_mixture(narrow, schedules, budget, max_repeats, seed).filter("copies > 0")
    plan = plan.select(
        F.col("doc_id").alias("__doc"), F.col("source").alias("__source"), F.col("size").alias("__words"), "positions"
    ).withColumnRenamed("positions", "__positions")
    same = (
        sized[doc_id].eqNullSafe(plan["__doc"])
        & sized[source].eqNullSafe(plan["__source"])
        & (sized["__size"] == plan["__words"])
    )
    taken = sized.join(plan.hint("shuffle_hash"), same)
    spread = taken.select(*docs.columns, F.posexplode("__positions").alias("__pass", "__position"))
    return by_position(spread, "__position", [source, doc_id, "__pass"]).select(*docs.columns).toDF(*names)
