"""Licence texts found in documents: MinHash bands retrieve templates, exact containment confirms them.

Texts and templates are cut into words (lower case, letters and digits of
ASCII) and these into five-word shingles; a template of fewer words is one
shingle of its own length and found only whole. Templates with m shingles of
equal length form a class. A document is covered by overlapping windows that begin at every
`step`-th shingle and are so long that any m neighbouring shingles lie within
one of them. If those m hold the share `containment` of a template, window and
template have a Jaccard similarity of at least

    need / (window + m - need),   need = ceil(containment * m)

and the class gets as many bands (of one MinHash each) as make the probability
that none collides less than `miss`. Collisions are then judged by their
shingles, as text: the share of the template's shingles in the window.

A window without any shingle of the class's templates can collide with none of
them, since a band's value is the hash of one shingle on either side; so
windows are made only around such shingles. Everything is Spark's own
functions, in one pass; the only shuffle gathers the matches per document.
Templates are a parameter, and their tables are broadcast: rows in proportion
to the templates' words, not to the documents. Those given by default are the
common families' texts, headers and notices; texts of one family contain most
of each other, so each of them is returned, with its containment.

Defined results: null, empty and short texts match nothing; texts of any
length are scanned whole; of windows with equal containment the first counts;
rows with equal ids are one document; an empty table gives an empty table;
further columns are not read.
"""

from __future__ import annotations

import math
import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripflow.llm.licence_texts import TEMPLATES
from tripflow.llm.quality import bind

SHINGLE = 5
CONTAINMENT = 0.8
MISS = 1e-6
MAX_TEMPLATE_WORDS = 200_000

def template_words(text: str) -> list[str]:
    return re.findall("[a-z0-9]+", text.lower())


def shingle_length(words: list[str]) -> int:
    return min(SHINGLE, len(words))


def shingles(words: list[str]) -> list[str]:
    k = shingle_length(words)
    return [" ".join(words[i : i + k]) for i in range(len(words) - k + 1)] if k else []


def settings(m: int, containment: float = CONTAINMENT, miss: float = MISS) -> tuple[int, int, int]:
    """Step, window and number of bands for templates of m shingles."""
    need = math.ceil(containment * m)
    step = max(1, m // 4)
    window = m + step - 1
    similarity = need / (window + m - need)
    bands = 1 if similarity >= 1 else math.ceil(math.log(miss) / math.log(1 - similarity))
    return step, window, bands


def _hash_at(words: Column, i: Column, k: int) -> Column:
    return F.xxhash64(*[F.get(words, i + j) for j in range(k)])


def _hashes(words: Column, k: Column, lengths: Sequence[int]) -> Column:
    """The hashes of all shingles of k words, which is one of `lengths`."""
    made = lambda n: F.transform(F.sequence(F.lit(0), F.size(words) - n), lambda i: _hash_at(words, i, n))
    return F.coalesce(*[F.when(k == n, made(n)) for n in lengths])


def _bands(hashes: Column, bands: Column) -> Column:
    """One MinHash per band over the shingles of a window."""

    def all_bands(hashes: Column) -> Column:
        least = lambda j: F.array_min(F.transform(hashes, lambda h: F.xxhash64(h, j)))
        return F.transform(F.sequence(F.lit(0), bands - 1), lambda j: F.struct(j.alias("band"), least(j).alias("value")))

    return bind(hashes, all_bands)


def _texts(words: Column, k: Column) -> Column:
    """The distinct shingles of a window, as text."""
    return F.array_distinct(
        F.transform(F.sequence(F.lit(1), F.size(words) - k + 1), lambda i: F.array_join(F.slice(words, i, k), " "))
    )


def find_licences(
    docs: DataFrame, templates: Mapping[str, str] = TEMPLATES, containment: float = CONTAINMENT, miss: float = MISS
) -> DataFrame:
    """doc_id, licence, containment, matched and all shingles, and the first word of the best window."""
    spark = docs.sparkSession
    cut = {name: template_words(text) for name, text in templates.items()}
    if sum(map(len, cut.values())) > MAX_TEMPLATE_WORDS:
        raise ValueError("the templates are too large to be broadcast")
    if empty := [name for name, words in cut.items() if not words]:
        raise ValueError(f"templates without words: {empty}")
    # A class is the length of the shingles and their number.
    kinds = {name: (shingle_length(words), len(shingles(words))) for name, words in cut.items()}
    classes = {kind: settings(kind[1], containment, miss) for kind in sorted(set(kinds.values()))}
    lengths = sorted({k for k, _ in classes})

    rows = [(name, words, *kinds[name], classes[kinds[name]][2]) for name, words in cut.items()]
    known = spark.createDataFrame(rows, "licence string, words array<string>, k int, m int, bands int").coalesce(1)
    hashes = _hashes(F.col("words"), F.col("k"), lengths)
    marks: dict[tuple[int, int], set[int]] = {kind: set() for kind in classes}
    for row in known.select("k", "m", hashes.alias("h")).collect():  # the templates
        marks[row["k"], row["m"]].update(row["h"])
    begins = {k: {s.split()[0] for name, words in cut.items() if kinds[name][0] == k for s in shingles(words)} for k in lengths}
    every = {k: set().union(*[marks[kind] for kind in classes if kind[0] == k]) for k in lengths}
    banded = known.select("licence", "k", "m", "words", F.explode(_bands(hashes, F.col("bands"))).alias("b"))
    index = F.broadcast(banded.select("licence", "k", "m", "b.band", "b.value", _texts(F.col("words"), F.col("k")).alias("shingles")))

    def of_class(hits: Column, words: Column, kind: tuple[int, int]) -> Column:
        (k, m), (step, window, bands) = kind, classes[kind]
        last = F.floor((F.size(words) - k) / F.lit(step)).cast("int")

        def around(hit: Column) -> Column:
            until = F.least(last, F.floor(hit["i"] / F.lit(step)).cast("int"))
            first = F.greatest(F.lit(0), F.ceil((hit["i"] - (window - 1)) / F.lit(step)).cast("int"))
            return F.sequence(F.least(first, until), until)

        def cut_out(start: Column) -> Column:
            at = (start * step).alias("at")
            own = F.slice(words, start * step + 1, window + k - 1).alias("words")
            return F.struct(F.lit(k).alias("k"), F.lit(m).alias("m"), F.lit(bands).alias("bands"), at, own)

        own = F.filter(hits, lambda h: h["h"].isin(*marks[kind]))
        return F.transform(F.array_distinct(F.flatten(F.transform(own, around))), cut_out)

    def windows(words: Column, k: int) -> Column:
        """Windows of the classes of shingle length k that hold a shingle of the class."""
        starts = F.sequence(F.lit(0), F.size(words) - k)
        known_at = lambda i: F.get(words, i).isin(*begins[k]) & _hash_at(words, i, k).isin(*every[k])
        hits = F.transform(F.filter(starts, known_at), lambda i: F.struct(i.alias("i"), _hash_at(words, i, k).alias("h")))
        all_classes = lambda h: F.when(F.size(h) > 0, F.concat(*[of_class(h, words, kind) for kind in classes if kind[0] == k]))
        return F.when(F.size(words) >= k, bind(hits, all_classes))

    def scan(words: Column) -> Column:
        return F.flatten(F.array_compact(F.array(*[windows(words, k) for k in lengths])))

    text = F.split(F.lower(F.coalesce(F.col("text"), F.lit(""))), "[^a-z0-9]+")
    scanned = docs.select("doc_id", bind(text, scan).alias("found")).filter(F.size("found") > 0)
    near = scanned.select("doc_id", F.explode("found").alias("w")).filter(F.size("w.words") >= F.col("w.k"))
    asked = near.select("doc_id", "w", F.explode(_bands(_hashes(F.col("w.words"), F.col("w.k"), lengths), F.col("w.bands"))).alias("b"))
    same = (F.col("w.k") == F.col("k")) & (F.col("w.m") == F.col("m"))
    same = same & (F.col("b.band") == F.col("band")) & (F.col("b.value") == F.col("value"))
    collided = asked.join(index, same).select("doc_id", "licence", "w", "shingles")
    found = F.size(F.array_intersect(_texts(F.col("w.words"), F.col("w.k")), F.col("shingles")))
    judged = collided.withColumn("matched", found.cast("long"))
    judged = judged.withColumn("n_shingles", F.size("shingles").cast("long"))
    passed = judged.filter(F.col("matched") >= F.ceil(F.lit(containment) * F.col("n_shingles") - 1e-9))
    best = passed.groupBy("doc_id", "licence", "n_shingles").agg(
        F.max(F.struct(F.col("matched"), (-F.col("w.at")).alias("back"))).alias("best")
    )
    return best.select(
        "doc_id", "licence", (F.col("best.matched") / F.col("n_shingles")).alias("containment"),
        F.col("best.matched").alias("matched"), "n_shingles", (-F.col("best.back")).cast("long").alias("first_word"),
    )
