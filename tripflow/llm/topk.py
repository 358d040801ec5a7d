"""Exact search for the highest inner products with KD-trees, one per shard.

Rows go to cells of space by the upper levels of one KD split, whose medians
come from a sample of at most `SAMPLE_NUMBERS` components (every row is placed,
and the results don't depend on the sample). A cell of more than `SHARD_ROWS` rows is
several shards, by hash. In a shard, median splits of the
widest side give a balanced tree whose nodes carry tight bounding boxes. A
query walks a tree best-first: for a box from `lo` to `hi` no product can pass
the sum of q * hi where q is positive and q * lo where it isn't, and the walk
ends when the best box left is below the kth score so far. A leaf's box lies in those above it, so the walk meets the
leaves in the order of their own bounds; queries take theirs in rounds, and a leaf is compared with all that have come to it. That score is
carried along: from shard to shard in a task, and from a first group of shards
to all others. The first group lies in the cell of the query's best bound; of the other
cells only those are asked whose tight box reaches the score found there.

Queries come in blocks of the same or neighbouring best cells, and shards in groups, both of bounded size; a task holds
one block and one group, and a group's trees go only to blocks with a query
that asks it. A block's rows in a task are about as large as a group's trees, so that the copies of
neither outweigh the other's. All arithmetic is on integers. Vectors of the `SPLIT_LENGTHS`
commonest lengths have cells; those of any other length are one cell a length.

Defined results: vectors that are null or hold null or non-finite components
take no part, as query or candidate, and neither do rows without an id;
vectors of other lengths than the query's
are no candidates; ties go to the smaller id; of query rows with equal ids the
smallest vector asks, and no row with its id answers; repeated candidates all
count; an empty table gives an empty table; further columns are not read. A
component or score that doesn't fit 64 bits raises.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripflow.session import materialise

SHARD_ROWS = 4_096
LEAF_ROWS = 64
BLOCK_QUERIES = 4_096
BLOCK_NUMBERS = 1 << 19  # components in a block at most: fewer queries of long vectors
GROUP_SHARDS = 4

# Bounds of what the driver holds: sampled components and rows per cell, for so many lengths.
SAMPLE_NUMBERS = 1 << 20
SAMPLE_PER_CELL = 16
SPLIT_LENGTHS = 4

TREES = (
    "dim int, cell int, shard int, n int, ids binary, vectors binary, low binary, high binary, "
    "box_low array<bigint>, box_high array<bigint>"
)
HITS = "query_id bigint, vec_id bigint, score bigint"

NONE = -(1 << 63)  # below any score


def quantised(vector: Column, scale: int = 256) -> Column:
    """floor(scale * x) of every component; null for vectors that take no part."""
    doubles = F.transform(vector, lambda x: x.cast("double"))
    bad = F.exists(doubles, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    whole = F.transform(doubles, lambda x: F.floor(F.lit(float(scale)) * x))
    return F.when(F.coalesce(~bad, F.lit(False)), whole)


class Tree:
    """A balanced tree over rows in leaf order; node k has the children 2k+1 and 2k+2."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, low: np.ndarray, high: np.ndarray, leaf: int = LEAF_ROWS):
        self.ids, self.vectors, self.low, self.high = ids, vectors, low, high
        self.spans = self.split(len(ids), leaf)

    @staticmethod
    def split(n: int, leaf: int) -> dict[int, tuple[int, int, bool]]:
        """First row, end and whether it is a leaf, per node."""
        spans, todo = {}, [(0, 0, n)]
        while todo:
            node, a, b = todo.pop()
            spans[node] = (a, b, b - a <= leaf)
            if b - a > leaf:
                todo += [(2 * node + 1, a, (a + b) // 2), (2 * node + 2, (a + b) // 2, b)]
        return spans

    @classmethod
    def build(cls, ids: np.ndarray, vectors: np.ndarray, leaf: int = LEAF_ROWS) -> Tree:
        spans = cls.split(len(ids), leaf)
        shape = (max(spans) + 1, vectors.shape[1])
        low, high, order = np.zeros(shape, np.int64), np.zeros(shape, np.int64), np.arange(len(ids))
        for node in sorted(spans):
            a, b, is_leaf = spans[node]
            rows = vectors[order[a:b]]
            low[node], high[node] = rows.min(0), rows.max(0)
            if not is_leaf and shape[1]:
                side = int(np.argmax(high[node] - low[node]))
                order[a:b] = order[a:b][np.argpartition(rows[:, side], (a + b) // 2 - a)]
        return cls(ids[order], vectors[order], low, high, leaf)

    def search(self, queries: np.ndarray, best: Best) -> None:
        """Adds what this tree has to each query's k best."""
        leaves = [(node, a, b) for node, (a, b, is_leaf) in self.spans.items() if is_leaf]
        nodes = [node for node, _, _ in leaves]
        bounds = box_bounds(queries, self.low[nodes], self.high[nodes])
        asked, points = queries.astype(bounds.dtype), self.vectors.astype(bounds.dtype)
        turns = np.argsort(bounds, axis=1, kind="stable")[:, ::-1]  # each query's leaves, best first
        rows, done, width = np.arange(len(queries)), 0, 1
        while rows.size and done < len(leaves):
            mine = turns[rows, done : done + width]
            open_ = bounds[rows[:, None], mine] >= best.kth(rows).astype(bounds.dtype)[:, None]
            for leaf in np.unique(mine[open_]):
                who, (_, a, b) = rows[(open_ & (mine == leaf)).any(1)], leaves[leaf]
                best.take(who, asked[who] @ points[a:b].T, self.ids[a:b])
            rows, done, width = rows[open_[:, -1]], done + width, 2 * width


class Best:
    """The k best rows found for each query: scores from the highest on, NONE where there are fewer, ties by the smaller id.

    `floors` are scores that k rows elsewhere are known to reach, or NONE; `own` are ids that don't answer.
    """

    def __init__(self, own: np.ndarray, floors: np.ndarray, k: int):
        self.own, self.floors = own, floors
        self.scores, self.ids = np.full((len(own), k), NONE, np.int64), np.zeros((len(own), k), np.int64)

    def kth(self, rows: np.ndarray) -> np.ndarray:
        """The score that a further row has to reach."""
        return np.maximum(self.floors[rows], self.scores[rows, -1])

    def take(self, rows: np.ndarray, scores: np.ndarray, ids: np.ndarray) -> None:
        """Takes up candidates, which have a score (column) for each of the given queries (row)."""
        good = scores >= self.kth(rows).astype(scores.dtype)[:, None]
        hit = np.flatnonzero(good.any(1))
        if not hit.size:
            return
        rows, good = rows[hit], good[hit] & (ids != self.own[rows[hit]][:, None])
        new = np.where(good, scores[hit].astype(np.int64), NONE)
        scores, ids = np.hstack([self.scores[rows], new]), np.hstack([self.ids[rows], np.broadcast_to(ids, new.shape)])
        order = np.lexsort((ids, ~scores), axis=1)[:, : self.scores.shape[1]]  # ~ turns the order round and can't overflow
        self.scores[rows], self.ids[rows] = np.take_along_axis(scores, order, 1), np.take_along_axis(ids, order, 1)


def exact_kind(queries: np.ndarray, low: np.ndarray, high: np.ndarray) -> type:
    """Floats or doubles where no sum can pass 2**24 or 2**53, else 64-bit integers; raises where these don't do."""
    top = lambda x: max((abs(int(v)) for v in (x.min(), x.max())), default=0) if x.size else 0
    most = top(queries) * max(top(low), top(high)) * max(1, queries.shape[1])
    if most >= 1 << 63:
        raise OverflowError("a score may not fit 64 bits")
    return np.float32 if most < 1 << 24 else np.float64 if most < 1 << 53 else np.int64


def box_bounds(queries: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """The highest product that each query (row) can have with a vector of each box (column)."""
    kind = exact_kind(queries, low, high)
    asked = queries.astype(kind)
    return np.maximum(asked, 0) @ high.astype(kind).T + np.minimum(asked, 0) @ low.astype(kind).T


@dataclass
class Cells:
    """The upper levels of a KD split; node k has the children 2k+1 and 2k+2, and a node without a side is a cell."""

    sides: np.ndarray
    values: np.ndarray

    @classmethod
    def split(cls, sample: np.ndarray, cells: int) -> Cells:
        sides, values, todo = {}, {}, [(0, np.arange(len(sample)), cells)]
        while todo:
            node, rows, share = todo.pop()
            own = sample[rows]
            spread = own.max(0) - own.min(0)
            side = int(np.argmax(spread))
            sides[node], values[node] = -1, 0
            if share < 2 or not spread[side]:
                continue
            x = own[:, side]
            value = np.sort(x)[len(x) // 2]
            value = value if value > x.min() else x[x > value].min()
            sides[node], values[node] = side, value
            todo += [(2 * node + 1, rows[x < value], share - share // 2), (2 * node + 2, rows[x >= value], share // 2)]
        numbers = range(max(sides) + 1)
        return cls(np.array([sides.get(k, -1) for k in numbers]), np.array([values.get(k, 0) for k in numbers], np.int64))

    def place(self, vectors: np.ndarray) -> np.ndarray:
        """The node of the cell that holds each vector."""
        node = np.zeros(len(vectors), np.int64)
        while (inner := np.flatnonzero(self.sides[node] >= 0)).size:
            at = node[inner]
            node[inner] = 2 * at + 1 + (vectors[inner, self.sides[at]] >= self.values[at])
        return node


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


def _by_length(df: DataFrame, lengths: list[int], fn: Callable, other: object, field: T.StructField, kind: pa.DataType) -> DataFrame:
    """Adds a column: `fn(dim, vectors, rows of the batch)` for rows of the given lengths, else `other`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims, out = batch.column("dim").to_numpy(), [other] * batch.num_rows
            for dim in lengths:
                rows = np.flatnonzero(dims == dim)
                if rows.size:
                    part = batch.take(pa.array(rows))
                    for row, value in zip(rows, fn(dim, _matrix(part.column("vector"), dim), part)):
                        out[row] = value
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, kind)], names=[*batch.schema.names, field.name])

    return df.mapInArrow(run, T.StructType([*df.schema.fields, field]))


def split_space(points: DataFrame) -> dict[int, Cells]:
    """The split of each of the commonest lengths that fill more than one shard."""
    lengths = points.filter("dim > 0").groupBy("dim").agg(F.count(F.lit(1)).alias("n"))
    out = {}
    for dim, n in lengths.orderBy(F.col("n").desc(), "dim").limit(SPLIT_LENGTHS).collect():
        rows = SAMPLE_NUMBERS // dim
        cells = min(-(-n // SHARD_ROWS), rows // SAMPLE_PER_CELL)
        if cells > 1:
            share = F.pmod(F.xxhash64(F.lit(2), "vec_id", "vector"), F.lit(1 << 62)) < int(min(1.0, rows / n) * (1 << 62))
            sample = points.filter((F.col("dim") == dim) & share).select("vector").limit(2 * rows).toArrow()["vector"].combine_chunks()
            if len(sample):
                out[dim] = Cells.split(_matrix(sample, dim), cells)
    return out


def plant(points: DataFrame, space: dict[int, Cells]) -> DataFrame:
    """A tree per shard of (dim, vec_id, vector) rows, with its cell, its group and its tight box."""
    place = lambda dim, vectors, _: space[dim].place(vectors)
    dealt = _by_length(points, list(space), place, 0, T.StructField("cell", T.IntegerType()), pa.int32())
    sizes = dealt.groupBy("dim", "cell").agg(F.ceil(F.count(F.lit(1)) / SHARD_ROWS).alias("shards"))  # a row per cell
    shard = F.pmod(F.xxhash64("vec_id", "vector"), F.col("shards")).cast("int")
    dealt = dealt.join(materialise(sizes), ["dim", "cell"]).withColumn("shard", shard)
    trees = dealt.groupBy("dim", "cell", "shard").applyInPandas(_plant, TREES)
    return materialise(trees.withColumn("group", F.floor(F.col("shard") / GROUP_SHARDS).cast("int")))


Boxes = dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]


def cell_boxes(trees: DataFrame, space: dict[int, Cells]) -> Boxes:
    """Cells and their lowest and highest corners per split length: at most SAMPLE_NUMBERS / SAMPLE_PER_CELL numbers each."""
    out = {}
    for dim in space:
        sides = F.posexplode(F.arrays_zip("box_low", "box_high")).alias("side", "box")
        ends = trees.filter(F.col("dim") == dim).select("cell", sides).groupBy("cell", "side")
        ends = ends.agg(F.min("box.box_low").alias("low"), F.max("box.box_high").alias("high")).toPandas().sort_values(["cell", "side"])
        corners = (ends[c].to_numpy(np.int64).reshape(-1, dim) for c in ("low", "high"))
        out[dim] = (np.unique(ends["cell"].to_numpy()), *corners)
    return out


def best_cell(queries: DataFrame, boxes: Boxes) -> DataFrame:
    """Adds `home`, the cell of each query's best bound."""

    def fn(dim: int, vectors: np.ndarray, _: pa.RecordBatch) -> np.ndarray:
        cells, low, high = boxes[dim]
        return cells[box_bounds(vectors, low, high).argmax(1)]

    return _by_length(queries, list(boxes), fn, 0, T.StructField("home", T.IntegerType()), pa.int32())


def cells_in_reach(queries: DataFrame, boxes: Boxes) -> DataFrame:
    """Adds `cells`, those whose box reaches the query's `floor`; all where it has none."""

    def fn(dim: int, vectors: np.ndarray, rows: pa.RecordBatch) -> Iterator[np.ndarray]:
        cells, low, high = boxes[dim]
        for bounds, floor in zip(box_bounds(vectors, low, high), rows.column("floor").to_pylist()):
            yield cells if floor is None else cells[bounds >= floor]

    return _by_length(queries, list(boxes), fn, [0], T.StructField("cells", T.ArrayType(T.IntegerType())), pa.list_(pa.int32()))


def few_copies(points: DataFrame, k: int) -> DataFrame:
    """Rows of ids that fill a shard are left in at most k equal copies: no answer holds more."""
    often = materialise(points.groupBy("vec_id").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > SHARD_ROWS).select("vec_id"))
    if often.isEmpty():
        return points
    counted = points.join(often, "vec_id", "left_semi").groupBy(*points.columns).agg(F.count(F.lit(1)).alias("n"))
    again = F.explode(F.sequence(F.lit(1), F.least(F.col("n"), F.lit(k)).cast("int")))
    folded = counted.withColumn("copy", again).select(*points.columns)
    return materialise(points.join(often, "vec_id", "left_anti").unionByName(folded))


def _plant(rows: pd.DataFrame) -> pd.DataFrame:
    dim = int(rows["dim"].iloc[0])
    vectors = np.array(rows["vector"].tolist(), np.int64).reshape(len(rows), dim)
    tree = Tree.build(rows["vec_id"].to_numpy(np.int64), vectors)
    small = np.int16 if vectors.size == 0 or np.abs(vectors).max() < 1 << 15 else np.int64
    pack = lambda x: x.astype(small).tobytes()
    return pd.DataFrame(
        {"dim": [dim], "cell": [int(rows["cell"].iloc[0])], "shard": [int(rows["shard"].iloc[0])], "n": [len(rows)],
         "ids": [tree.ids.tobytes()], "vectors": [pack(tree.vectors)], "low": [pack(tree.low)], "high": [pack(tree.high)],
         "box_low": [tree.low[0].tolist()], "box_high": [tree.high[0].tolist()]}
    )


def _revive(row: pd.Series) -> Tree:
    n, dim = int(row["n"]), int(row["dim"])
    nodes = max(Tree.split(n, LEAF_ROWS)) + 1
    kind = np.int16 if len(row["low"]) == nodes * dim * 2 else np.int64
    read = lambda name: np.frombuffer(row[name], kind).astype(np.int64).reshape(-1, dim) if dim else np.zeros((nodes if name != "vectors" else n, 0), np.int64)
    return Tree(np.frombuffer(row["ids"], np.int64), read("vectors"), read("low"), read("high"))


def _searcher(k: int):
    def run(asked: pd.DataFrame, trees: pd.DataFrame) -> pd.DataFrame:
        """One block of queries of one length against one group of shards."""
        none = pd.DataFrame({c: pd.Series([], dtype="int64") for c in ("query_id", "vec_id", "score")})
        if not len(asked) or not len(trees):
            return none
        vectors = np.array(asked["vector"].tolist(), np.int64).reshape(len(asked), -1)
        best = Best(asked["query_id"].to_numpy(np.int64), asked["floor"].to_numpy(np.int64), k)
        for _, row in trees.iterrows():
            _revive(row).search(vectors, best)
        query, place = np.nonzero(best.scores != NONE)
        return pd.DataFrame({"query_id": best.own[query], "vec_id": best.ids[query, place], "score": best.scores[query, place]})

    return run


def in_blocks(queries: DataFrame) -> DataFrame:
    """Adds `part`: queries of one length, in the order of their homes, are blocks of about BLOCK_QUERIES rows; stored."""
    queries = materialise(queries)
    sizes = queries.groupBy("dim", "home").agg(F.count(F.lit(1)).alias("n"))  # a row per cell
    earlier = Window.partitionBy("dim").orderBy("home").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.withColumn("before", F.coalesce(F.sum("n").over(earlier), F.lit(0)))
    block = F.least(F.lit(BLOCK_QUERIES), F.greatest(F.lit(1), F.floor(BLOCK_NUMBERS / F.greatest("dim", F.lit(1)))))
    part = F.floor((F.col("before") + F.pmod(F.xxhash64("query_id"), F.col("n"))) / block).cast("int")
    return materialise(queries.join(F.broadcast(sizes), ["dim", "home"]).withColumn("part", part).drop("n", "before"))


def asked_groups(asked: DataFrame, trees: DataFrame) -> DataFrame:
    """A row per query and group of a cell in its reach, but for the group that was asked first."""
    groups = trees.select("dim", "cell", "group").distinct()  # a row per group of shards
    # Sizes are guessed before cells are exploded: without the hint the queries, once per cell, may be what the driver broadcasts.
    later = asked.withColumn("cell", F.explode("cells")).drop("cells").join(F.broadcast(groups), ["dim", "cell"])
    return later.filter((F.col("cell") != F.col("home")) | (F.col("group") != 0))


def search(asked: DataFrame, trees: DataFrame, k: int) -> DataFrame:
    """The hits of each query in the group of its row; a task holds one block and one group."""
    work = ["dim", "part", "cell", "group"]
    # New names for the same columns, so that both sides can be told apart.
    wanted = asked.select(*[F.col(c).alias(f"{c}_") for c in work]).distinct()
    sent = wanted.withColumnsRenamed({f"{c}_": c for c in work}).join(trees.hint("merge"), ["dim", "cell", "group"])  # no tree to the driver
    asked = asked.select(*work, "query_id", "vector", F.coalesce("floor", F.lit(NONE)).alias("floor"))
    return asked.groupBy(*work).cogroup(sent.groupBy(*work)).applyInPandas(_searcher(k), HITS)


def top_k(vectors: DataFrame, is_query: Column, k: int = 5, scale: int = 256) -> DataFrame:
    """query_id, rank, vec_id and score of each query's k best rows; (vec_id, embedding) is read."""
    read = vectors.select("vec_id", quantised(F.col("embedding"), scale).alias("vector")).filter("vec_id IS NOT NULL AND vector IS NOT NULL")
    points = materialise(read.withColumn("dim", F.size("vector")))
    points = few_copies(points, k)
    space = split_space(points)
    trees = plant(points, space)
    boxes = cell_boxes(trees, space)

    queries = points.filter(is_query).groupBy(F.col("vec_id").alias("query_id")).agg(F.min(F.struct("dim", "vector")).alias("v"))
    queries = in_blocks(best_cell(queries.select("query_id", "v.*"), boxes))

    first = queries.withColumns({"cell": F.col("home"), "group": F.lit(0), "floor": F.lit(None).cast("long")})
    hits = materialise(search(first, trees, k))
    full = hits.groupBy("query_id").agg(F.when(F.count(F.lit(1)) >= k, F.min("score")).alias("floor"))
    asked = materialise(cells_in_reach(queries.join(full, "query_id", "left"), boxes))
    rest = search(asked_groups(asked, trees), trees, k)
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), F.col("vec_id"))
    ranked = hits.unionByName(rest).withColumn("rank", F.row_number().over(order).cast("int"))
    return ranked.filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
