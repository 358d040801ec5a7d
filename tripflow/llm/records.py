"""Token ids in files of length-delimited binary records, and an index for shuffled reads.

A record frames one document:

    8 bytes  length of the payload, unsigned
    4 bytes  masked CRC-32 of those 8 bytes
    payload  1 byte bytes per id, 4 bytes number of ids, the ids
    4 bytes  masked CRC-32 of the payload

All integers are little-endian. The mask turns a checksum right by 15 bits and
adds 0xa282ead8, so that a checksum over data that holds checksums is no trap.
Ids take two bytes where the vocabulary allows it. The index is a Parquet
table with a row per record: doc_id, file, offset, size, n_tokens, part, start.

Documents are ranged by doc_id, so files and the records in them follow its
ascending order. A task writes to files with names of its own and names them
in its index rows only; what a lost task leaves is named nowhere.

Defined results: a null or empty text is a record with the end id; null ids
come first; rows with equal ids follow the order of their texts; an empty table
gives an empty index; a very long text is one record, held in one task; further columns are not read.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tripflow.llm.tokens import in_parts, load_tokenizer, width_for, worker_encoder
from tripflow.session import materialise, scratch_path, shuffle_parts
from tripflow.sources.footers import arrow_filesystem, store_settings

END_ID = 0
FILE_BYTES = 256 << 20

# Files that a task holds open while it reads records in any order.
OPEN_FILES = 64
HEAD, TAIL, INNER = "<QI", "<I", "<BI"

INDEX = "doc_id bigint, file string, offset bigint, size bigint, n_tokens bigint, part int, before bigint"


def masked(data: bytes) -> int:
    crc = zlib.crc32(data)
    return ((crc >> 15 | crc << 17) + 0xA282EAD8) & 0xFFFFFFFF


def frame(ids: bytes, width: int) -> bytes:
    """One record for ids of `width` bytes each."""
    payload = struct.pack(INNER, width, len(ids) // width) + ids
    length = struct.pack("<Q", len(payload))
    return b"".join([struct.pack(HEAD, len(payload), masked(length)), payload, struct.pack(TAIL, masked(payload))])


def unframe(record: bytes) -> bytes:
    """The ids of a record as unsigned 32-bit integers; raises if a checksum is wrong."""
    head = struct.calcsize(HEAD)
    length, check = struct.unpack_from(HEAD, record)
    payload = record[head : head + length]
    if check != masked(record[:8]) or len(payload) != length or struct.unpack_from(TAIL, record, head + length)[0] != masked(payload):
        raise ValueError("a record is damaged")
    width, n = struct.unpack_from(INNER, payload)
    return np.frombuffer(payload, f"<u{width}", n, struct.calcsize(INNER)).astype("<u4").tobytes()


def write_records(docs: DataFrame, folder: str, tokenizer: str, end_id: int = END_ID, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Writes record files below `folder`, a place that all executors reach, and returns the stored index."""
    data = load_tokenizer(tokenizer)
    width = width_for(data)
    shared = docs.sparkSession.sparkContext.broadcast(data)  # one vocabulary file
    end = np.array([end_id], f"<u{width}").tobytes()

    def coded(batch: pa.RecordBatch) -> list[bytes]:
        return [ids + end for ids in worker_encoder(shared.value, width).encode(batch.column("text"))]

    return _write(docs.select("doc_id", "text"), coded, folder, width, file_bytes)


def write_ids(rows: DataFrame, folder: str, width: int = 4, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Writes records of given ids, rows of (doc_id, ids as unsigned 32-bit integers), with `width` bytes each."""

    def coded(batch: pa.RecordBatch) -> list[bytes]:
        found = []
        for value in batch.column("ids"):
            ids = np.frombuffer(value.as_py() or b"", "<u4")
            if len(ids) and int(ids.max()) >> (8 * width):
                raise OverflowError("an id does not fit the width of the file")
            found.append(ids.astype(f"<u{width}").tobytes())
        return found

    return _write(rows.select("doc_id", "ids"), coded, folder, width, file_bytes)


def _write(
    read: DataFrame, coded: Callable[[pa.RecordBatch], list[bytes]], folder: str, width: int, file_bytes: int
) -> DataFrame:
    """Ranges (doc_id, content) by both, writes what `coded` makes of the content, and returns the stored index."""
    settings, content = store_settings(read.sparkSession), read.columns[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, own = TaskContext.get().partitionId(), uuid.uuid4().hex
        system, base = arrow_filesystem(folder, settings)
        out, name, files, at, before = None, "", 0, 0, 0
        try:
            for batch in (part for whole in batches for part in in_parts(whole, content)):
                names, offsets, sizes, counts, starts = [], [], [], [], []
                for ids in coded(batch):
                    if out is None or at >= file_bytes:
                        if out is not None:
                            out.close()
                        name, files, at = f"part-{part:06d}-{files:04d}-{own}.rec", files + 1, 0
                        system.create_dir(base, recursive=True)
                        out = system.open_output_stream(f"{base}/{name}")
                    record = frame(ids, width)
                    n = len(ids) // width
                    out.write(record)
                    names.append(name), offsets.append(at), sizes.append(len(record)), counts.append(n), starts.append(before)
                    at, before = at + len(record), before + n
                whole = [pa.array(x, pa.int64()) for x in (offsets, sizes, counts)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").cast(pa.int64()), pa.array(names, pa.string()), *whole,
                     pa.array([part] * len(names), pa.int32()), pa.array(starts, pa.int64())],
                    names=["doc_id", "file", "offset", "size", "n_tokens", "part", "before"],
                )
        finally:
            if out is not None:
                out.close()

    ranged = read.repartitionByRange(shuffle_parts(read.sparkSession), "doc_id", F.crc32(F.col(content).cast("binary")))
    index = materialise(ranged.sortWithinPartitions("doc_id", content).mapInArrow(run, INDEX))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row per range
    firsts = index.groupBy("part").agg(F.sum("n_tokens").alias("__n"))
    firsts = firsts.select(F.col("part").alias("__part"), F.coalesce(F.sum("__n").over(earlier), F.lit(0)).alias("__first"))
    placed = index.join(F.broadcast(firsts), F.col("part") == F.col("__part"))  # a row per range
    return placed.select(*index.columns[:-1], (F.col("before") + F.col("__first")).alias("start"))


def read_records(index: DataFrame, folder: str) -> DataFrame:
    """The records that index rows name, in any order: the index's columns and `ids`, unsigned 32-bit integers."""
    names, settings = index.columns, store_settings(index.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, base = arrow_filesystem(folder, settings)

        @lru_cache(OPEN_FILES)
        def opened(name: str):
            return system.open_input_file(f"{base}/{name}")  # closed when it falls out and nobody holds it

        for batch in batches:
            ids, held, kept = [], 0, 0
            rows = zip(*(batch.column(c).to_pylist() for c in ("file", "offset", "size")))
            for row, (file, offset, size) in enumerate(rows):
                source = opened(file)
                source.seek(offset)
                ids.append(unframe(source.read(size)))
                held += size
                if held > 32 << 20 or row + 1 == batch.num_rows:
                    some = batch.slice(kept, len(ids))
                    yield pa.RecordBatch.from_arrays([*some.columns, pa.array(ids, pa.binary())], names=[*names, "ids"])
                    kept, ids, held = row + 1, [], 0

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in index.schema.fields)
    return index.mapInArrow(run, f"{fields}, ids binary")


def round_trip(docs: DataFrame, tokenizer: str) -> DataFrame:
    """Writes all documents below the shared folder and reads every record back."""
    folder = scratch_path(docs.sparkSession, "records")
    return read_records(write_records(docs, folder, tokenizer), folder)
