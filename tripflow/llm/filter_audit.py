"""Filter interaction audit: what each filter of a chain removes, in every order of the chain.

One table of failing ids is stored per filter. The survivors of a prefix of the
chain are the rows left by a left-anti join with the table of each of its
filters, and what a filter removes behind a prefix are the rows of a left-semi
join with its table that survive the prefix. Which rows survive doesn't depend on the
order inside the prefix, so all prefixes are followed at once: a row that fails
any filter is repeated per set of filters, and a filter's anti join looks only
at the sets that hold it. The rows were dealt out by their number before, so
these joins need no further shuffle, and the numbers are unique, so no task gets more than its share
whatever ids and texts repeat. Rows that fail nothing are counted once.

Texts are read in one pass, which leaves a narrow table. Copies are told by
SHA-256; the first id per text is joined back only for texts that repeat, and
texts with many copies by broadcast, of which there are fewer than shuffle
partitions.

Defined results: a null or empty text has no words and no characters; a null part is
the part named by the empty string; a null id is never a copy, never labelled
and doesn't make a copy of another; rows that repeat an id count one by one, and
equal texts under one id are no copies of each other; of several labels of an id the highest
count; long texts are read whole; an empty table gives an empty table; further columns are ignored.
"""

from __future__ import annotations

import itertools
from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripflow.llm.quality import bind, words_of
from tripflow.operators.joins import attach_per_key
from tripflow.session import materialise, shuffle_parts

# Every order of the filters is reported, so a chain may hold so many.
MOST_FILTERS = 7

# Fewer copies of a text than this never need splitting.
HOT_COPIES = 1_000


def measures(text: Column) -> Column:
    """The counts that the filters read."""

    def of(words: Column) -> Column:
        known = F.get(words, F.lit(0)) != ""
        return F.struct(
            F.when(known, F.size(words)).otherwise(F.lit(0)).alias("words"),
            F.when(known, F.size(F.array_distinct(words))).otherwise(F.lit(0)).alias("distinct"),
            F.regexp_count(text, F.lit("[A-Z]")).alias("capitals"),
            F.length(text).alias("chars"),
            text.rlike("[#$%&*|]").alias("symbol"),
        )

    return bind(words_of(text), of)


# Filter letters and when a text fails; None is the filter of copies of a text with a smaller id.
Filters = Mapping[str, Callable[[Column], Column] | None]
FILTERS: Filters = {
    "A": lambda m: m["words"] < 100,
    "B": lambda m: 100 * m["distinct"] < 80 * m["words"],
    "C": lambda m: 100 * m["capitals"] > 10 * m["chars"],
    "D": lambda m: m["symbol"],
    "E": None,
}


def narrow_rows(docs: DataFrame, labels: DataFrame, filters: Filters, text: str, part: str) -> DataFrame:
    """One narrow row per document: number, id, part, labels, text digest, and the letters it fails by itself."""
    body = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    letters = lambda m: F.array_compact(F.array(*[F.when(f(m), F.lit(x)) for x, f in filters.items() if f]))
    rows = docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.col("doc_id"),
        F.coalesce(F.col(f"`{part}`").cast("string"), F.lit("")).alias("part"),
        F.unhex(F.sha2(body, 256)).alias("digest"),
        bind(measures(body), letters).alias("fails"),
    )
    marks = labels.filter("doc_id IS NOT NULL").groupBy(F.col("doc_id").alias("labelled")).agg(
        F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic")
    )
    rows = materialise(rows)  # the numbers have to stay
    known = rows.filter("doc_id IS NOT NULL").join(marks, F.col("doc_id") == F.col("labelled"), "left").drop("labelled")
    marked = known.unionByName(rows.filter("doc_id IS NULL"), allowMissingColumns=True)
    return materialise(marked.fillna(0, ["good", "toxic"]))


def _copies(rows: DataFrame) -> DataFrame:
    """The rows whose text a smaller id has too."""
    texts = rows.groupBy(F.col("digest").alias("of")).agg(F.count(F.lit(1)).alias("copies"), F.min("doc_id").alias("first"))
    texts = materialise(texts.filter("copies > 1"))
    found = attach_per_key(rows.select("row", "doc_id", "digest"), texts, [("digest", "of")], "copies", hot_rows=HOT_COPIES)
    return found.filter("doc_id > first")


def failing_ids(rows: DataFrame, filters: Filters = FILTERS) -> dict[str, DataFrame]:
    """One stored table per filter with the row numbers and ids that fail it."""
    return {
        x: materialise((_copies(rows) if fails is None else rows.filter(F.array_contains("fails", x))).select("row", "doc_id"))
        for x, fails in filters.items()
    }


def _sets(of: int, filters: int) -> list[int]:
    """All sets of filters, as bits, that leave out the bits `of`."""
    return [s for s in range(1 << filters) if not s & of]


def prefix_counts(rows: DataFrame, failing: Mapping[str, DataFrame]) -> tuple[DataFrame, DataFrame]:
    """Survivors per (part, prefix), and removals per (part, prefix, filter); a prefix is a set of filters as bits."""
    parts = shuffle_parts(rows.sparkSession)
    base = rows.select("row", "part", "good", "toxic").repartition(parts, "row")
    ids = {x: t.select("row").repartition(parts, "row").hint("shuffle_hash") for x, t in failing.items()}
    bits = {x: 1 << i for i, x in enumerate(failing)}
    n = len(bits)

    def survivors(of: DataFrame, but: int) -> DataFrame:
        alive = of.withColumn("prefix", F.explode(F.array(*map(F.lit, _sets(but, n)))))
        for x, bit in bits.items():
            if not bit & but:
                alive = alive.join(ids[x], (alive["row"] == ids[x]["row"]) & (F.col("prefix").bitwiseAND(bit) != 0), "left_anti")
        return alive

    clean, touched = base, None
    for x in bits:
        clean = clean.join(ids[x], "row", "left_anti")
        own = base.join(ids[x], "row", "left_semi")
        # Each failing row once: under the first filter that it fails.
        for y in list(bits)[: list(bits).index(x)]:
            own = own.join(ids[y], "row", "left_anti")
        touched = own if touched is None else touched.unionByName(own)
    unhurt = clean.groupBy("part").agg(F.count(F.lit(1)).alias("rows"))
    unhurt = unhurt.withColumn("prefix", F.explode(F.array(*map(F.lit, range(1 << n)))))
    left = survivors(touched, 0).groupBy("part", "prefix").agg(F.count(F.lit(1)).alias("rows"))
    kept = left.unionByName(unhurt.select("part", "prefix", "rows")).groupBy("part", "prefix").agg(F.sum("rows").alias("kept"))
    gone = None
    for x, bit in bits.items():
        removed = survivors(base.join(ids[x], "row", "left_semi"), bit).groupBy("part", "prefix").agg(
            F.count(F.lit(1)).alias("removed"), F.sum("good").alias("good_lost"), F.sum("toxic").alias("toxic_lost")
        )
        removed = removed.withColumn("filter", F.lit(x))
        gone = removed if gone is None else gone.unionByName(removed)
    return kept, gone


def chain_steps(letters: str) -> list[tuple[str, int, str, int, int]]:
    """Every step of every order: order, step, filter, and the sets of filters before and after it."""
    out = []
    for order in itertools.permutations(letters):
        before = 0
        for step, x in enumerate(order, 1):
            after = before | 1 << letters.index(x)
            out.append(("".join(order), step, x, before, after))
            before = after
    return out


def audit(
    docs: DataFrame, labels: DataFrame, filters: Filters = FILTERS, text: str = "text", part: str = "lang"
) -> DataFrame:
    """One row per part, order of the filters and step, with what the step's filter does there.

    `labels` holds doc_id, quality and toxic. Filters are named by one letter each.
    """
    letters = "".join(filters)
    if len(letters) != len(filters) or len(letters) > MOST_FILTERS:
        raise ValueError(f"filters are named by one letter each and are {MOST_FILTERS} at most")
    rows = narrow_rows(docs, labels, filters, text, part)
    kept, gone = prefix_counts(rows, failing_ids(rows, filters))
    kept, gone = materialise(kept), materialise(gone)  # a row per part and set of filters
    steps = docs.sparkSession.createDataFrame(
        chain_steps(letters), "filter_order string, step int, filter string, before int, after int"
    )
    # Below 36,000 rows, whatever the corpus. Every part has a row per set of filters, so none is missing.
    parts = rows.select("part").distinct()
    grid = parts.withColumn("after", F.explode(F.array(*map(F.lit, range(1 << len(letters))))))
    grid = grid.join(kept.withColumnRenamed("prefix", "after"), ["part", "after"], "left").join(F.broadcast(steps), "after")
    grid = grid.join(gone.withColumnRenamed("prefix", "before"), ["part", "before", "filter"], "left")
    grid = grid.fillna(0, ["kept", "removed", "good_lost", "toxic_lost"])
    own = Window.partitionBy("part", "filter")  # all orders of one chain
    return grid.select(
        "part", "filter_order", "step", "kept", "removed",
        (F.max(F.when(F.col("step") == 1, F.col("removed"))).over(own) - F.col("removed")).alias("redundant"),
        F.max(F.when(F.col("step") == len(letters), F.col("removed"))).over(own).alias("unique_fails"),
        "good_lost", "toxic_lost",
        F.sum("removed").over(own).alias("shapley"),
    )
