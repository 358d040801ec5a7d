"""Toxicity by compression distance: which of two zstandard dictionaries shortens a text's windows.

One dictionary is trained on ordinary and one on toxic text of labelled
documents: each holds the words that mark its class, the strongest last, as
raw content. A window is one word of the text between two runs of padding, so
that its compressed length tells how much of the word a dictionary holds,
prefixes and parts included. Window length and gain, ordinary minus toxic,
make a cell, and each cell has a threshold-free weight: the log ratio of the
shares of toxic and ordinary documents that show it, measured on labelled
documents that trained no dictionary. A logistic curve over the strongest
weights, fitted there too, turns them into a score.

The classifier is fitted on a bounded sample, `MAX_PER_CLASS` labelled rows
of each class; all texts are scored, and read whole.

Defined results: a null or empty text has no windows and gets the score of
that; without labels of both classes every score is the share of toxic
labels; of several labels of a document the highest counts, null labels don't;
null ids are never held out and never labelled; an empty table gives an empty
table; further columns are kept in `score`, but one named like the result
gives way to it.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripflow.llm.ranking import map_batches
from tripflow.session import materialise

MAX_PER_CLASS = 6_000
ORDINARY_BYTES, TOXIC_BYTES = 64_000, 32_000
MIN_Z, MIN_LOG_ODDS = 5.0, 2.0
WINDOW_BYTES = 48
PAD = b"~" * 32
STRIPPED = ".,;:!?\"'()[]"
LONGEST, GAINS = 16, (-2, 10)
REMEMBERED = 400_000


def windows(text: str) -> tuple[set[bytes], int]:
    """The distinct windows of a text, and its number of words."""
    words = text.lower().split()
    out = set()
    for word in set(words):
        coded = word.strip(STRIPPED).encode()
        out.update(coded[i : i + WINDOW_BYTES] for i in range(0, len(coded), WINDOW_BYTES))
    return out, len(words)


@dataclass
class Model:
    prior: float = 0.0
    ordinary: bytes = b""
    toxic: bytes = b""
    weights: dict[tuple[int, int], float] = field(default_factory=dict)
    curve: tuple[float, ...] = ()


class Gauge:
    """Compresses windows with both dictionaries and remembers the cells of the first ones."""

    def __init__(self, model: Model):
        import zstandard

        self.model, self.cells = model, {}
        settings = zstandard.ZstdCompressionParameters(
            strategy=zstandard.STRATEGY_BTLAZY2, min_match=5, window_log=18, hash_log=17, chain_log=17, search_log=7,
            target_length=128, write_checksum=False, write_content_size=False, write_dict_id=False,
        )
        both = (zstandard.ZstdCompressionDict(d or b"\0" * 8, dict_type=zstandard.DICT_TYPE_RAWCONTENT) for d in (model.ordinary, model.toxic))
        self.plain, self.marked = (zstandard.ZstdCompressor(dict_data=d, compression_params=settings) for d in both)

    def cell(self, window: bytes) -> tuple[int, int]:
        found = self.cells.get(window)
        if found is None:
            framed = b"%s %s %s" % (PAD, window, PAD)
            gain = len(self.plain.compress(framed)) - len(self.marked.compress(framed))
            found = min(len(window), LONGEST), max(GAINS[0], min(gain, GAINS[1]))
            if len(self.cells) < REMEMBERED:
                self.cells[window] = found
        return found

    def features(self, text: str) -> tuple[float, float, float]:
        """The highest weight, the sum of the three highest, and the log of the number of words."""
        found, n = windows(text)
        weights = self.model.weights
        best = sorted((weights.get(self.cell(w), 0.0) for w in found), reverse=True)[:3]
        return (best[0] if best else 0.0), sum(best), float(np.log1p(n))

    def score(self, text: str) -> float:
        if not self.model.curve:
            return self.model.prior
        z = float(np.dot(self.model.curve, (1.0, *self.features(text))))
        return 1.0 / (1.0 + float(np.exp(-max(-30.0, min(30.0, z)))))


def fit_curve(x: np.ndarray, y: np.ndarray, penalty: float = 1e-2, steps: int = 50) -> tuple[float, ...]:
    """Logistic regression with an intercept, by Newton's method."""
    x = np.hstack([np.ones((len(x), 1)), x])
    w = np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (p - y) + penalty * w
        w -= np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + penalty * np.eye(len(w)), slope)
    return tuple(map(float, w))


def is_held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def _mark(docs: DataFrame, fn: Callable, schema: str, model: Model) -> DataFrame:
    """Maps (text, toxic) rows of training documents by `fn(gauge, text, toxic)` to rows of `schema`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gauge = Gauge(model)
        for batch in batches:
            rows = [r for t, y in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist()) for r in fn(gauge, t or "", y)]
            yield pa.RecordBatch.from_pylist(rows, schema=pa.schema(fields))

    kinds = {"binary": pa.binary(), "int": pa.int32(), "double": pa.float64()}
    fields = [(n, kinds[k]) for n, k in (part.split() for part in schema.split(", "))]
    return docs.select("text", "toxic").mapInArrow(run, schema)


def _fill(rows: list, size: int) -> bytes:
    """The strongest words that fit, the strongest last."""
    out, room = [], size
    for row in rows:
        room -= len(row["window"]) + 1
        if room < 0:
            break
        out.append(bytes(row["window"]))
    return b" " + b" ".join(reversed(out)) + b" "


def train(docs: DataFrame, labels: DataFrame, max_per_class: int = MAX_PER_CLASS) -> Model:
    """A model from the labelled documents that aren't held out."""
    known = labels.filter("doc_id IS NOT NULL AND toxic IS NOT NULL").filter(~is_held_out(F.col("doc_id")))
    known = known.groupBy("doc_id").agg(F.max((F.col("toxic") > 0).cast("int")).alias("toxic"))
    order = F.xxhash64(F.lit(80), "doc_id")
    sample = [known.filter(F.col("toxic") == y).orderBy(order, "doc_id").limit(max_per_class) for y in (0, 1)]
    sample = sample[0].unionByName(sample[1])  # at most two times max_per_class rows
    rows = sample.collect()
    n = [sum(r["toxic"] == y for r in rows) for y in (0, 1)]
    if not all(n):
        return Model(prior=n[1] / max(1, sum(n)))
    chosen = docs.sparkSession.createDataFrame([(r["doc_id"], r["toxic"]) for r in rows], "doc_id long, toxic int")
    fold = F.crc32(F.concat(F.lit("fold"), F.col("doc_id").cast("string")).cast("binary")) % 3
    trained = materialise(docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").withColumn("fold", fold))
    first, second = trained.filter("fold <> 0"), trained.filter("fold = 0")

    sizes = {r["toxic"]: r["n"] for r in first.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    n0, n1 = sizes.get(0, 0), sizes.get(1, 0)
    if not n0 or not n1:
        return Model(prior=n[1] / sum(n))
    model = Model(n[1] / sum(n))
    words = _mark(first, lambda _, text, y: [{"window": w, "toxic": y} for w in windows(text)[0]], "window binary, toxic int", model)
    counts = materialise(words.groupBy("window").agg(F.sum("toxic").alias("c1"), F.sum(1 - F.col("toxic")).alias("c0")))
    expected = (F.col("c0") + F.col("c1")) * n1 / (n0 + n1)
    odds = F.log(((F.col("c1") + 0.5) / (n1 + 1)) / ((F.col("c0") + 0.5) / (n0 + 1)))
    marks = ((F.col("c1") - expected) / F.sqrt(expected) >= MIN_Z) & (odds >= MIN_LOG_ODDS)
    most = lambda df, c, size: df.orderBy(F.col(c).desc(), "window").limit(size // 2).collect()  # noqa: E731  # bounded by the bytes
    toxic = _fill(most(counts.filter(marks), "c1", TOXIC_BYTES), TOXIC_BYTES)
    ordinary = _fill(most(counts.filter(~marks), "c0", ORDINARY_BYTES), ORDINARY_BYTES)
    model.ordinary, model.toxic = ordinary, toxic

    def cells(gauge: Gauge, text: str, y: int) -> list[dict]:
        return [{"length": a, "gain": b, "toxic": y} for a, b in {gauge.cell(w) for w in windows(text)[0]}]

    shown = _mark(second, cells, "length int, gain int, toxic int", model).groupBy("length", "gain").agg(
        F.sum("toxic").alias("c1"), F.sum(1 - F.col("toxic")).alias("c0")
    )
    sizes = {r["toxic"]: r["n"] for r in second.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    m0, m1 = sizes.get(0, 0), sizes.get(1, 0)
    for r in shown.collect():  # a row per cell
        model.weights[r["length"], r["gain"]] = float(np.log(((r["c1"] + 0.5) / (m1 + 1)) / ((r["c0"] + 0.5) / (m0 + 1))))

    def look(gauge: Gauge, text: str, y: int) -> list[dict]:
        return [dict(zip(("best", "three", "size"), gauge.features(text)), toxic=y)]

    seen = _mark(second, look, "best double, three double, size double, toxic int", model).collect()  # the sample
    if len({r["toxic"] for r in seen}) == 2:
        x = np.array([[r["best"], r["three"], r["size"]] for r in seen])
        model.curve = fit_curve(x, np.array([r["toxic"] for r in seen], float))
    return model


def score(docs: DataFrame, model: Model, out: str = "score") -> DataFrame:
    """Every document with its score between 0 and 1."""
    docs = docs.drop(out)
    names = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gauge = Gauge(model)  # two dictionaries and some hundred weights
        for batch in batches:
            scores = pa.array([gauge.score(t or "") for t in batch.column("text").to_pylist()], pa.float64())
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), scores], names=[*names, out])

    return map_batches(docs, run, T.StructType([*docs.schema.fields, T.StructField(out, T.DoubleType())]))

