"""Packing documents into sequences of a fixed number of tokens, best-two-fit.

A bin is filled greedily with the longest piece that still fits. Then its
smallest piece gives way to two unpacked pieces that together fill the gap
plus the piece's place more tightly, as long as there are such.

The choice depends only on how many pieces of each length are left, and there
are at most as many lengths as a sequence has tokens. So the bins are planned
on counts per length: a bin's pattern repeats until one of its lengths runs
out, and the plan is a few thousand patterns for a table of any size. The
pieces are then ranked inside their length and look up their place.

`pack_in_order` keeps a training order: the table is cut into stretches of
`STRETCH_ROWS` documents by the order in which its files hold them, each
stretch is packed for itself in one task, and sequences are numbered by their
first document. Pieces of a full sequence stand alone and are dealt to tasks of
their own, so a stretch holds less than a sequence per document however long
these are. A stretch ends with one sequence that may be far from full.

Defined results: a null or empty text is one piece with the end id; repeated
rows are packed like any others; equal lengths are told apart by a seeded key
of doc_id, then doc_id, piece and start; an empty table gives an empty table.
`pack` and `pack_in_order` keep further columns, but those named like the ones they add give way;
null ids are packed like any others. A very long text is many pieces, each a row of its own. Frames that
read no files have no order of their own: `in_file_order` numbers them by the seeded key. Names that begin
with two underscores are working names.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripflow.llm.ranking import rank_in_groups, shuffle_key, shuffle_slot, slots_for
from tripflow.llm.tokens import in_parts, load_tokenizer, worker_encoder
from tripflow.session import materialise

LENGTH = 1024
END_ID = 2
SEED = 30

# Ranks below this are kept apart per length in one sorted array.
RANKS = 1 << 48

# Documents that are packed together where their order counts.
STRETCH_ROWS = 1024

# Sequences that may begin in one document; a text has at most 2**31 bytes, so it has fewer full pieces.
NUMBERS = 1 << 22

# Bytes of text that are encoded in one go.
PART_BYTES = 4 << 20

# Full pieces of a document that one task takes.
LONE_PIECES = 1024

PIECES = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("piece", T.IntegerType()),
        T.StructField("start", T.LongType()),
        T.StructField("length", T.LongType()),
        T.StructField("ids", T.BinaryType()),
    ]
)


def cut(total: int, length: int = LENGTH) -> list[tuple[int, int]]:
    """Start and length of a document's pieces; only the first may be shorter than `length`."""
    first = total % length or min(total, length)
    return [(0, first), *((s, length) for s in range(first, total, length))]


def pieces(docs: DataFrame, tokenizer: str, length: int = LENGTH, end_id: int = END_ID, keep: Sequence[str] = ()) -> DataFrame:
    """Whole texts to pieces with their ids, as little-endian unsigned 32-bit integers; `keep` names further columns."""
    shared = docs.sparkSession.sparkContext.broadcast(load_tokenizer(tokenizer))  # one vocabulary file
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = worker_encoder(shared.value, 4)
        for batch in (part for whole in batches for part in in_parts(whole, most=PART_BYTES)):
            of, number, starts, lengths, ids = [], [], [], [], []
            for row, coded in enumerate(encoder.encode(batch.column("text"))):
                coded += end
                for k, (start, size) in enumerate(cut(len(coded) // 4, length)):
                    of.append(row), number.append(k), starts.append(start), lengths.append(size)
                    ids.append(coded[4 * start : 4 * (start + size)])
            rows = pa.array(of, pa.int64())
            columns = [
                batch.column("doc_id").take(rows).cast(pa.int64()), pa.array(number, pa.int32()),
                pa.array(starts, pa.int64()), pa.array(lengths, pa.int64()), pa.array(ids, pa.binary()),
                *(batch.column(c).take(rows) for c in keep),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)
        # The worker lives on for other stages: what Arrow doesn't use goes back.
        pa.default_memory_pool().release_unused()

    kept = docs.select("doc_id", "text", *(F.col(f"`{c}`") for c in keep))
    schema = T.StructType([*PIECES.fields, *kept.schema.fields[2:]])
    return kept.mapInArrow(run, schema)


def _greedy(lengths: list[int], left: dict[int, int], gap: int) -> tuple[list[int], int]:
    """Lengths from longest to smallest that fill a gap."""
    bin_, at = [], bisect_right(lengths, gap) - 1
    while at >= 0:
        size = lengths[at]
        n = min(left[size], gap // size)
        bin_.extend([size] * n)
        gap -= n * size
        at = min(at - 1, bisect_right(lengths, gap) - 1)
    return bin_, gap


def _two(lengths: list[int], free: dict[int, int], room: int) -> tuple[int, int]:
    """The two free lengths with the largest sum within `room`; of these, those furthest apart."""
    best, found = 0, (0, 0)
    low, high = 0, bisect_right(lengths, room - 1) - 1
    while low <= high:
        a, b = lengths[low], lengths[high]
        if not free[a]:
            low += 1
        elif not free[b] or a + b > room or (low == high and free[a] < 2):
            high -= 1
        else:
            if a + b > best:
                best, found = a + b, (b, a)
            low += 1
    return found


def plan(counts: dict[int, int], length: int = LENGTH) -> list[tuple[list[int], int]]:
    """Patterns of bins, longest piece first, and how many bins follow each."""
    left = {size: n for size, n in counts.items() if n}
    if left and not 1 <= min(left) <= max(left) <= length:
        raise ValueError("a piece has to hold 1 token at least and must fit a sequence")
    lengths, patterns = sorted(left), []
    while lengths:
        bin_, gap = _greedy(lengths, left, length)
        while gap:
            free = dict(left)
            for size in bin_:
                free[size] -= 1
            pair = _two(lengths, free, gap + bin_[-1])
            if sum(pair) <= bin_[-1]:
                break
            gap += bin_[-1] - sum(pair)
            bin_ = sorted([*bin_[:-1], *pair], reverse=True)
        used = {size: bin_.count(size) for size in set(bin_)}
        times = min(left[size] // n for size, n in used.items())
        patterns.append((bin_, times))
        for size, n in used.items():
            left[size] -= n * times
            if not left[size]:
                del left[size]
        lengths = [size for size in lengths if size in left]
    return patterns


def places(patterns: list[tuple[list[int], int]]) -> np.ndarray:
    """Rows (key, first sequence, copies per bin, offset), sorted by key = length * RANKS + first rank."""
    rows, taken, sequence = [], {}, 0
    for bin_, times in patterns:
        offset = 0
        for size in sorted(set(bin_), reverse=True):
            n = bin_.count(size)
            first = taken.get(size, 0)
            rows.append((size * RANKS + first, sequence, n, offset))
            taken[size] = first + n * times
            offset += n * size
        sequence += times
    return np.array(sorted(rows), np.int64).reshape(-1, 4)


def look_up(table: np.ndarray, size: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sequence and offset of pieces, from the rows of `places`, by length and rank inside it."""
    keys, first, copies, offset = table.T
    wanted = size * RANKS + rank
    at = np.searchsorted(keys, wanted, "right") - 1
    nth = wanted - keys[at]
    return first[at] + nth // copies[at], offset[at] + nth % copies[at] * size


def pack(parts: DataFrame, length: int = LENGTH, seed: int = SEED) -> DataFrame:
    """Adds `sequence_id` and `offset` to rows with doc_id, piece, start and length."""
    parts = parts.drop("sequence_id", "offset")
    keyed = materialise(parts.withColumn("__key", shuffle_key(seed, F.col("doc_id"))))
    counts = {r["length"]: r["n"] for r in keyed.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}  # `length` rows
    table = keyed.sparkSession.sparkContext.broadcast(places(plan(counts, length)))  # bounded by the patterns
    slots = slots_for(sum(counts.values()))
    ranked = rank_in_groups(
        keyed.withColumn("__slot", shuffle_slot(F.col("__key"), slots)),
        ["length"], "__slot", ["__key", "doc_id", "piece", "start"], rank="__rank",
    ).drop("__slot", "__key")

    names = parts.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            added = map(pa.array, look_up(table.value, batch.column("length").to_numpy(), batch.column("__rank").to_numpy()))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), *added], names=[*names, "sequence_id", "offset"])

    added = [T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())]
    return ranked.mapInArrow(run, T.StructType([*parts.schema.fields, *added]))


def in_file_order(docs: DataFrame, name: str = "__place", seed: int = SEED) -> DataFrame:
    """Adds the number of each row in the order of the files that `docs` reads, part files by number, rows by place."""
    docs = docs.drop(name)
    own = [f"`{c}`" for c in docs.columns]
    try:
        about = docs.metadataColumn("_metadata")
        stored = docs.select("*", about["file_path"].alias("__file"), about["row_index"].alias("__row"))
    except AnalysisException as error:
        if error.getCondition() not in ("UNRESOLVED_COLUMN.WITH_SUGGESTION", "UNRESOLVED_COLUMN.WITHOUT_SUGGESTION", "CANNOT_RESOLVE_DATAFRAME_COLUMN"):
            raise
        keyed = materialise(docs.withColumn("__key", shuffle_key(seed, F.col("doc_id"))))
        slotted = keyed.withColumn("__slot", shuffle_slot(F.col("__key"), slots_for(keyed.count())))
        return rank_in_groups(slotted, [], "__slot", ["__key", "doc_id", "text"], rank="__at").select(*own, F.col("__at").alias(name))
    held = {r["__file"]: r["n"] for r in stored.groupBy("__file").agg(F.count(F.lit(1)).alias("n")).collect()}  # a row per file
    first, rows = 0, []
    for file in sorted(held, key=lambda f: [int(x) if x.isdigit() else x for x in re.split(r"(\d+)", f)]):
        rows.append((file, first))
        first += held[file]
    firsts = docs.sparkSession.createDataFrame(rows, "__of string, __first bigint")
    # A file may lack the rows that a filter took: numbers grow with the order, and aren't gapless then.
    joined = stored.join(F.broadcast(firsts), F.col("__file") == F.col("__of"))  # a row per file
    return joined.withColumn(name, F.col("__first") + F.col("__row")).drop("__of", "__first", "__file", "__row")


def _pack_stretch(pieces: pa.Table, place: str, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Sequence and offset of the pieces of one stretch; sequences follow the first document in them."""
    at, size, piece = (pieces.column(c).to_numpy() for c in (place, "length", "piece"))
    sequence, offset = at * NUMBERS + piece + 1, np.zeros(len(at), np.int64)
    short = np.flatnonzero(size < length)
    if len(short):
        short = short[np.lexsort((at[short], size[short]))]
        kinds, starts, counts = np.unique(size[short], return_index=True, return_counts=True)
        rank = np.arange(len(short)) - np.repeat(starts, counts)
        table = places(plan(dict(zip(kinds.tolist(), counts.tolist())), length))
        number, offset[short] = look_up(table, size[short], rank)
        first = np.full(number.max() + 1, np.iinfo(np.int64).max)
        np.minimum.at(first, number, at[short])
        sequence[short] = first[number] * NUMBERS
    return sequence, offset


def pack_in_order(parts: DataFrame, place: str = "__place", length: int = LENGTH, rows: int = STRETCH_ROWS) -> DataFrame:
    """Adds `sequence_id` and `offset` to pieces whose documents are numbered; ids grow with the numbers."""
    parts = parts.drop("sequence_id", "offset")
    kept = [c for c in parts.columns if c != place]
    schema = T.StructType(
        [*(parts.schema[c] for c in kept), T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())]
    )

    def run(table: pa.Table) -> pa.Table:
        added = _pack_stretch(table, place, length)
        return pa.Table.from_arrays([*(table.column(c) for c in kept), *map(pa.array, added)], names=schema.names)

    lone = F.xxhash64(place, F.floor(F.col("piece") / LONE_PIECES))
    alone = F.when(F.col("length") >= length, lone)  # null: packed with the stretch
    return parts.groupBy(F.floor(F.col(place) / rows), alone).applyInArrow(run, schema)


def sequences(packed: DataFrame) -> DataFrame:
    """Packed pieces with ids to whole sequences: sequence_id, length, ids and the pieces in order."""
    inside = F.sort_array(F.collect_list(F.struct("offset", "doc_id", "piece", "length", "ids")))  # a sequence's pieces
    whole = packed.groupBy("sequence_id").agg(F.sum("length").alias("length"), inside.alias("pieces"))
    joined = F.aggregate("pieces", F.lit(b"").cast("binary"), lambda a, p: F.concat(a, p["ids"]))
    return whole.select("sequence_id", "length", joined.alias("ids"), F.transform("pieces", lambda p: p.dropFields("ids")).alias("pieces"))
