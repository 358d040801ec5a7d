"""Line deduplication over exact counts and sharded cuckoo filters.

`LineIndex` holds, for every line key of the documents put into it, the number
of documents that have it (a table, exact), and per shard of the key space a
cuckoo filter with the keys found in `min_docs` documents or more. Documents
can be put in and taken out; a key that crosses the bound enters or leaves its
shard's filter, so the index after a deletion is the one that was there before
the insertion. A lookup asks the filters first, and only lines they know are
joined with the exact counts.

A key is a line without blanks (space, 09 to 0D) at its ends and with A to Z
lower-cased, as a 128-bit BLAKE2 digest. Lines whose key is shorter than
`min_chars` code points are no keys and always stay.

Defined results: a null or empty text is one empty line and its kept text is
empty; every row counts as a document, repeated rows too; rows with equal ids
are each cleaned by the same keys; an empty table gives an empty table; further
columns are kept, but those named like a result (`n_lines`, `n_dropped` and
`kept_text`, after the caller's prefix) give way to it.
Lines of a hot key are counted before they are shuffled and probed in cells of
bounded size, each with a copy of its shard's filter.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripflow.llm.cuckoo import CuckooFilter
from tripflow.llm.ranking import map_batches
from tripflow.session import materialise, shuffle_parts

BLANKS = b" \t\n\x0b\f\r"
MIN_DOCS = 10
MIN_CHARS = 1

# Bounds of the rows that one probing cell holds.
MIN_CELL, MAX_CELL = 2_048, 1_000_000

# Frequent keys of a shard on average, from which on the shards are doubled.
SHARD_KEYS = 1_000_000

COUNTS = "hi bigint, lo bigint, shard int, n bigint"
FILTERS = "shard int, filter binary"
SETTINGS = "min_docs int, min_chars int, shards int"
RESULTS = {"n_lines": T.LongType(), "n_dropped": T.LongType(), "kept_text": T.StringType()}


def line_key(line: bytes) -> bytes:
    return line.strip(BLANKS).lower()


def long_enough(key: bytes, min_chars: int) -> bool:
    """Whether a UTF-8 key has `min_chars` code points; a code point takes four bytes at most."""
    return len(key) >= 4 * min_chars or len(key.decode("utf-8", "replace")) >= min_chars


def digest(key: bytes) -> bytes:
    return hashlib.blake2b(key, digest_size=16).digest()


def document_keys(docs: DataFrame, min_chars: int = MIN_CHARS, shards: int = 1) -> DataFrame:
    """One row per document and distinct key: doc_id, hi, lo and shard."""
    id_type = docs.schema["doc_id"].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, found = [], []
            for text in batch.column("text").to_pylist():
                keys = {k for k in map(line_key, (text or b"").split(b"\n")) if long_enough(k, min_chars)}
                counts.append(len(keys))
                found.extend(map(digest, keys))
            halves = np.frombuffer(b"".join(found), "<i8").reshape(-1, 2)
            ids = batch.column("doc_id").take(pa.array(np.repeat(np.arange(len(counts)), counts)))
            shard = (halves[:, 0].astype(np.uint64) >> np.uint64(33)).astype(np.int64) % shards
            columns = [ids, pa.array(halves[:, 0]), pa.array(halves[:, 1]), pa.array(shard.astype(np.int32))]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "hi", "lo", "shard"])

    read = docs.select("doc_id", F.col("text").cast("binary").alias("text"))
    return read.mapInArrow(run, f"doc_id {id_type.simpleString()}, hi bigint, lo bigint, shard int")


def _build(shard_rows: pd.DataFrame) -> pd.DataFrame:
    hi, lo = shard_rows["hi"].to_numpy(), shard_rows["lo"].to_numpy()
    room = len(hi)
    while True:
        made = CuckooFilter.for_keys(room)
        if made.insert(hi, lo):
            return pd.DataFrame({"shard": [int(shard_rows["shard"].iloc[0])], "filter": [made.to_bytes()]})
        room *= 2


def _change(filters: pd.DataFrame, changes: pd.DataFrame) -> pd.DataFrame:
    """The shard's filter after its changes; null if it is full."""
    if not len(changes):
        return filters
    shard = int(changes["shard"].iloc[0])
    if not len(filters):
        return pd.DataFrame({"shard": [shard], "filter": pd.Series([None], dtype=object)})
    table = CuckooFilter.from_bytes(filters["filter"].iloc[0])
    for enters in (False, True):
        rows = changes[changes["enters"] == enters]
        hi, lo = rows["hi"].to_numpy(), rows["lo"].to_numpy()
        if not enters:
            table.delete(hi, lo)
        elif not table.insert(hi, lo):
            return pd.DataFrame({"shard": [shard], "filter": pd.Series([None], dtype=object)})
    return pd.DataFrame({"shard": [shard], "filter": [table.to_bytes()]})


class LineIndex:
    """Exact document counts per line key, and a cuckoo filter per shard over the frequent keys.

    Both are tables in the shared folder, written anew by each change; `save`
    copies them to a folder of one's own, from which `open` goes on in another
    session. The shards are doubled as the frequent keys grow.
    """

    def __init__(self, spark: SparkSession, min_docs: int = MIN_DOCS, min_chars: int = MIN_CHARS, shards: int | None = None):
        self.spark, self.min_docs, self.min_chars = spark, min_docs, min_chars
        self.shards = shards or max(16, shuffle_parts(spark))
        self.counts: DataFrame | None = None
        self.filters = spark.createDataFrame([], FILTERS)

    @classmethod
    def open(cls, spark: SparkSession, path: str) -> LineIndex:
        """The index that `save` wrote; its files stay as they are when it changes."""
        index = cls(spark, **spark.read.schema(SETTINGS).parquet(f"{path}/settings").first().asDict())
        index.counts = spark.read.schema(COUNTS).parquet(f"{path}/counts")
        index.filters = spark.read.schema(FILTERS).parquet(f"{path}/filters")
        return index

    def save(self, path: str) -> None:
        """Writes the index to a folder that must not be there yet; the settings come last, so only a whole index opens."""
        counts = self.spark.createDataFrame([], COUNTS) if self.counts is None else self.counts
        counts.select("hi", "lo", "shard", F.col("n").cast("long").alias("n")).write.parquet(f"{path}/counts")
        self.filters.write.parquet(f"{path}/filters")
        settings = [(self.min_docs, self.min_chars, self.shards)]
        self.spark.createDataFrame(settings, SETTINGS).coalesce(1).write.parquet(f"{path}/settings")

    def _dealt(self, keys: DataFrame) -> DataFrame:
        """Keys with their shard of now: they may have been made when there were fewer."""
        return keys.withColumn("shard", (F.shiftrightunsigned("hi", 33) % self.shards).cast("int"))

    def _grow(self) -> None:
        """Doubles the shards until a mean one holds SHARD_KEYS, and builds all filters anew."""
        frequent, before = self.frequent().count(), self.shards
        while frequent > SHARD_KEYS * self.shards:
            self.shards *= 2
        if self.shards != before:
            self.counts = materialise(self._dealt(self.counts))
            self.filters = materialise(self.frequent().groupBy("shard").applyInPandas(_build, FILTERS))

    def keys(self, docs: DataFrame) -> DataFrame:
        """The stored keys of documents, to be put in, taken out or looked up."""
        return materialise(document_keys(docs, self.min_chars, self.shards))

    def insert(self, keys: DataFrame) -> None:
        self._apply(keys, 1)

    def delete(self, keys: DataFrame) -> None:
        """Takes documents out that were put in before; raises if one was not."""
        self._apply(keys, -1)

    def _apply(self, keys: DataFrame, sign: int) -> None:
        change = self._dealt(keys).groupBy("hi", "lo", "shard").agg((sign * F.count(F.lit(1))).alias("change"))
        if self.counts is None:
            merged = change.select("hi", "lo", "shard", F.lit(0).cast("long").alias("before"), F.col("change").alias("n"))
        else:
            both = self.counts.withColumn("change", F.lit(0).cast("long")).unionByName(change.withColumn("n", F.lit(0).cast("long")))
            merged = both.groupBy("hi", "lo", "shard").agg(F.sum("n").alias("before"), F.sum(F.col("n") + F.col("change")).alias("n"))
        negative = F.raise_error(F.lit("a document that is not in the index was to be deleted")).cast("long")
        merged = materialise(merged.withColumn("n", F.when(F.col("n") < 0, negative).otherwise(F.col("n"))))
        self.counts = merged.filter("n > 0").drop("before")
        enters, was = F.col("n") >= self.min_docs, F.col("before") >= self.min_docs
        changes = merged.filter(enters != was).select("shard", "hi", "lo", enters.alias("enters"))
        updated = materialise(
            self.filters.groupBy("shard").cogroup(changes.groupBy("shard")).applyInPandas(_change, FILTERS)
        )
        full = updated.filter("filter IS NULL").select("shard")
        rebuilt = self.frequent().join(full, "shard", "left_semi").groupBy("shard").applyInPandas(_build, FILTERS)
        self.filters = materialise(updated.filter("filter IS NOT NULL").unionByName(rebuilt))
        self._grow()

    def frequent(self) -> DataFrame:
        """The keys at or above the bound, exactly."""
        if self.counts is None:
            return self.spark.createDataFrame([], "hi bigint, lo bigint, shard int")
        return self.counts.filter(F.col("n") >= self.min_docs).select("hi", "lo", "shard")

    def probe(self, keys: DataFrame) -> DataFrame:
        """The rows of `keys` that the filters know: all frequent ones, and a few others.

        A shard's rows are dealt to cells by document, so a hot key is no
        cell's burden, and every cell is sent its shard's filter ahead of its
        rows. A cell is streamed, never held.
        """
        keys = self._dealt(keys)
        held = {r["shard"]: r["n"] for r in keys.groupBy("shard").agg(F.count(F.lit(1)).alias("n")).collect()}  # a row per shard
        size = max(MIN_CELL, min(MAX_CELL, 2 * sum(held.values()) // self.shards))
        rows, first = [], 0
        for shard in range(self.shards):
            cells = max(1, -(-held.get(shard, 0) // size))
            rows.append((shard, first, cells))
            first += cells
        dealing = F.broadcast(self.spark.createDataFrame(rows, "shard int, first int, cells int"))  # a row per shard
        place = F.col("first") + F.pmod(F.xxhash64("doc_id"), F.col("cells")).cast("int")
        asked = keys.join(dealing, "shard").select(place.alias("cell"), F.lit(None).cast("binary").alias("filter"), "doc_id", "hi", "lo")
        spread = F.explode(F.sequence(F.col("first"), F.col("first") + F.col("cells") - 1))
        nobody = [F.lit(None).cast(keys.schema["doc_id"].dataType).alias("doc_id"), *[F.lit(0).cast("long").alias(c) for c in ("hi", "lo")]]
        sent = self.filters.join(dealing, "shard").select(spread.alias("cell"), "filter", *nobody)
        parts = shuffle_parts(self.spark)
        stream = asked.unionByName(sent).repartitionById(parts, F.col("cell") % parts)
        stream = stream.sortWithinPartitions("cell", F.col("filter").asc_nulls_last())

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            cell, table = None, None
            for batch in batches:
                cells = batch.column("cell").to_numpy()
                hi = batch.column("hi").to_numpy()
                lo = batch.column("lo").to_numpy()
                known = np.zeros(len(cells), bool)
                bounds = [0, *(np.flatnonzero(np.diff(cells)) + 1), len(cells)]
                for start, end in zip(bounds, bounds[1:]):
                    if start == end:
                        continue
                    if cells[start] != cell:
                        cell, table = cells[start], None
                    blob = batch.column("filter")[start].as_py()
                    if blob is not None:
                        table = CuckooFilter.from_bytes(blob)
                        start += 1
                    if table is not None and start < end:
                        known[start:end] = table.contains(hi[start:end], lo[start:end])
                yield batch.select(["doc_id", "hi", "lo"]).filter(pa.array(known))

        id_type = keys.schema["doc_id"].dataType.simpleString()
        return stream.mapInArrow(run, f"doc_id {id_type}, hi bigint, lo bigint")

    def repeated_lines(self, keys: DataFrame) -> DataFrame:
        """Per document the digests of its frequent keys: doc_id, drop."""
        exact = self.probe(keys).join(self.frequent().select("hi", "lo"), ["hi", "lo"])
        return exact.groupBy("doc_id").agg(F.collect_set(F.struct("hi", "lo")).alias("drop"))

    def clean(self, docs: DataFrame, keys: DataFrame | None = None, prefix: str = "") -> DataFrame:
        """All documents with n_lines, n_dropped and kept_text, named after `prefix`."""
        keys = self.keys(docs) if keys is None else keys
        results = [prefix + c for c in RESULTS]
        docs = docs.drop(*results)
        drops = self.repeated_lines(keys)
        drops = drops.select(F.col("doc_id").alias("__doc"), "drop").hint("shuffle_hash")
        joined = docs.join(drops, docs["doc_id"].eqNullSafe(drops["__doc"]), "left").drop(drops["__doc"])  # the drop is the last column
        min_chars = self.min_chars
        names = docs.columns

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                total, gone, kept = [], [], []
                for text, drop in zip(batch.column("text").to_pylist(), batch.column(len(names)).to_pylist()):
                    text = text or ""
                    if not drop:
                        total.append(text.count("\n") + 1), gone.append(0), kept.append(text)
                        continue
                    out = {np.array([d["hi"], d["lo"]], "<i8").tobytes() for d in drop}
                    lines, stay = text.split("\n"), []
                    for line in lines:
                        key = line_key(line.encode())
                        if not (long_enough(key, min_chars) and digest(key) in out):
                            stay.append(line)
                    total.append(len(lines)), gone.append(len(lines) - len(stay)), kept.append("\n".join(stay))
                added = [pa.array(total, pa.int64()), pa.array(gone, pa.int64()), pa.array(kept, pa.string())]
                columns = batch.columns[: len(names)] + added
                yield pa.RecordBatch.from_arrays(columns, names=[*names, *results])

        added = [T.StructField(c, kind) for c, kind in zip(results, RESULTS.values())]
        return map_batches(joined, run, T.StructType([*docs.schema.fields, *added]))


def dedup_lines(docs: DataFrame, min_docs: int = MIN_DOCS, min_chars: int = MIN_CHARS, prefix: str = "") -> DataFrame:
    """Drops from every document the lines whose key is found in `min_docs` documents of the table."""
    index = LineIndex(docs.sparkSession, min_docs, min_chars)
    keys = index.keys(docs)
    index.insert(keys)
    return index.clean(docs, keys, prefix)
