"""Documents linked by the Jaccard similarity of their word n-gram sets.

Documents with equal sets form one class, which its smallest id stands for.
Classes are joined by prefixes. All tokens have one global order: first those
of a fixed share of the hash space, from rare to frequent as counted over all
classes, then the others. Of n tokens, any partner shares t * n at least, so
two similar sets share tokens among their first ones. A token is a signature
by itself if it is rare. Frequent tokens are dealt to classes by their hash
and index only as pairs of one class; each class in use then may hide one
shared token, so the prefix is extended. It ends where

    sum over rare tokens of 1 + sum over classes of (its tokens - 1)
    >= n - ceil(t * n) + 1

and has a signature in common with every partner's. Tokens found in one class
only count in that sum but need no index entry: a set with enough of them has
no partner and drops out. The share of the hash space and the number of token
classes depend on the power of two below the set's size; a set that may have
partners in the power below signs for both.

Sets that share a signature are first compared with one of them, the hub, so a
group of thousands of near copies costs one comparison each. Where the sets of
a signature are still in several components, they are compared across these in
blocks: a task holds two blocks and returns only links that join components.
Most sets that share a signature are far apart, so all comparisons begin with
marks: a bit per place of a hash, the parity of the tokens there, about as many
bits as tokens. Every token that only one of two sets has turns one bit, so marks
differ in no more bits than the sets in tokens, and two sets whose marks differ
in more than a link allows are not linked. Only what is left has its whole
sets moved and compared. These comparisons are exact, over the sets' 64-bit hashes. `class_links` and
`link_counts` compare all sets of a component, so they return every link.

Defined results: a null, empty or blank text has no n-grams and is linked
with nothing; a text with fewer words than an n-gram has one, its whole
sequence; repeated rows are in one class; rows that repeat an id have to
repeat the text; a row without an id takes the component of its text's class,
null if no id has it; an empty table gives an empty table; further columns
are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripflow.llm.components import components
from tripflow.session import materialise, small_batches

# A token found in so many classes is frequent.
FREQUENT = 32
REMEMBERED = 300_000
# Tokens of a set, at the least, for each class of frequent tokens.
PER_CLASS = 16
# Share of the hash space whose tokens are counted, by bits of the set size, in
# multiples of the share of tokens that a partner may lack.
SHARES = ((6, 10.0), (8, 2.2), (10, 1.6), (64, 1.3))
# Copies up to this many are told to all tasks; more are shuffled.
BROADCAST_COPIES = 1_000_000
# Bytes of the bitmap of ids, where there are more.
BITMAP_BYTES = 8 << 20
# Sets in a block of the last comparison, and their tokens, on average.
BLOCK, BLOCK_TOKENS = 2_048, 4_000_000

SIGNED = (
    "doc_id bigint, n bigint, hi bigint, lo bigint, mark binary, "
    "bands array<struct<power:int,counted:array<bigint>,others:array<bigint>>>"
)


class WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        import xxhash

        value = xxhash.xxh3_64_intdigest(word)
        if len(self) < REMEMBERED:
            self[word] = value
        return value


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


def token_set(text: bytes | None, size: int, known: WordHashes) -> np.ndarray:
    """The sorted distinct hashes of a text's n-grams."""
    words = (text or b"").lower().split()
    n = len(words)
    hashes = np.fromiter(map(known.__getitem__, words), np.uint64, n)
    if n == 0:
        return hashes
    parts = min(n, size)
    total = np.full(n - parts + 1, parts, np.uint64)
    for k in range(parts):
        total = mixed(total + hashes[k : n - parts + 1 + k])
    return np.unique(total)


def mark_of(tokens: np.ndarray) -> bytes:
    """For each place, by the tokens' lowest bits, the parity of the tokens there; places are the power of two from their number on."""
    places = max(64, 1 << max(0, len(tokens) - 1).bit_length())
    counts = np.bincount((tokens & np.uint64(places - 1)).view(np.int64), minlength=places)
    return np.packbits((counts & 1).astype(bool), bitorder="little").tobytes()


def folded(marks: np.ndarray, words: int) -> np.ndarray:
    """Marks, a row each, with fewer places; what the places that meet have adds up to their parity."""
    while marks.shape[-1] > words:
        half = marks.shape[-1] // 2
        marks = marks[..., :half] ^ marks[..., half:]
    return marks


def may_be_linked(x: np.ndarray, y: np.ndarray, total: np.ndarray | int, percent: int) -> np.ndarray:
    """Whether marks differ in no more bits than two linked sets of so many tokens in all can in tokens."""
    words = min(x.shape[-1], y.shape[-1])
    apart = np.bitwise_count(folded(x, words) ^ folded(y, words)).sum(axis=-1, dtype=np.int64)
    return apart * (100 + percent) <= total * (100 - percent)


def needed(n: int, percent: int) -> int:
    """Tokens that any partner of a set of n shares with it, at the least."""
    return -(-n * percent // 100)


def share_of(power: int, percent: int) -> float:
    return min(1.0, next(share for bits, share in SHARES if power < bits) * (100 - percent) / 100)


def candidates(tokens: np.ndarray, percent: int) -> list[tuple[int, np.ndarray, np.ndarray]]:
    """Per power of two that a set signs for: its counted tokens, and others in case they don't suffice."""
    n, out = len(tokens), []
    if n < 2:  # the partners of a set of one token are its copies
        return out
    need = n - needed(n, percent) + 1
    spread = mixed(tokens)
    for power in range(needed(n, percent).bit_length() - 1, n.bit_length()):
        low = spread >> np.uint64(32) < np.uint64(int(share_of(power, percent) * (1 << 32)))
        short = need + classes_of(power) - int(low.sum())
        rest = ~low
        others = tokens[rest][np.argsort(spread[rest])][: max(0, short)]
        out.append((power, tokens[low], others))
    return out


def classes_of(power: int) -> int:
    return max(1, (1 << power) // PER_CLASS)


def signatures(n: int, power: int, counted: int, shared: np.ndarray, counts: np.ndarray, others: np.ndarray, percent: int) -> np.ndarray:
    """The signatures of a set: `shared` are those of its counted tokens that other sets have, with their counts."""
    need = n - needed(n, percent) + 1 - (counted - len(shared))
    if need <= 0:
        return shared[:0]
    order = np.lexsort((shared, counts))
    shared, counts = shared[order], counts[order]
    rare = shared[counts < FREQUENT][:need]
    out, need = [rare], need - len(rare)
    common = shared[counts >= FREQUENT]
    if need > 0 and len(common):
        dealt = (mixed(common) % np.uint64(classes_of(power))).astype(np.int64)
        credit = np.ones(len(common), np.int64)
        credit[np.unique(dealt, return_index=True)[1]] = 0
        gained = np.cumsum(credit)
        end = int(np.searchsorted(gained, need)) + 1
        order = np.argsort(dealt[:end], kind="stable")
        chosen, of = common[:end][order], dealt[:end][order]
        for gap in range(1, len(chosen)):
            same = of[gap:] == of[:-gap]
            if not same.any():
                break
            a, b = chosen[:-gap][same], chosen[gap:][same]
            out.append(mixed(mixed(np.minimum(a, b) + np.uint64(power)) + np.maximum(a, b)))
        need -= int(gained[min(end, len(gained)) - 1])
    if need > 0:
        out.append(others[:need])
    return np.unique(np.concatenate(out))


def _read(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))


def signed_sets(docs: DataFrame, size: int, percent: int) -> DataFrame:
    """Per document the size, a 128-bit digest and the mark of its set, and the tokens it may sign with."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import hashlib

        known = WordHashes()
        for batch in batches:
            for start in range(0, batch.num_rows, 1024):
                some = batch.slice(start, 1024)
                sizes, digests, marks, powers, counted, others, ends = [], [], [], [], [], [], [0]
                for text in some.column("text").to_pylist():
                    tokens = token_set(text, size, known)
                    sizes.append(len(tokens))
                    digests.append(hashlib.blake2b(tokens.tobytes(), digest_size=16).digest())
                    marks.append(mark_of(tokens))
                    for power, low, rest in candidates(tokens, percent):
                        powers.append(power), counted.append(low), others.append(rest)
                    ends.append(len(powers))
                halves = np.frombuffer(b"".join(digests), "<i8").reshape(-1, 2)
                bands = pa.StructArray.from_arrays(
                    [pa.array(powers, pa.int32()), _lists(counted), _lists(others)], names=["power", "counted", "others"]
                )
                bands = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), bands)
                columns = [some.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(halves[:, 0]), pa.array(halves[:, 1]), pa.array(marks, pa.binary()), bands]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n", "hi", "lo", "mark", "bands"])

    return _read(docs).mapInArrow(run, SIGNED)


def _lists(parts: list[np.ndarray]) -> pa.ListArray:
    flat = np.concatenate([np.zeros(0, np.uint64), *parts]).view(np.int64)
    return pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, parts)]), pa.int32()), pa.array(flat))


def signature_index(heads: DataFrame, percent: int) -> DataFrame:
    """(doc_id, n, signature) of the class heads, from their candidate tokens."""
    bands = heads.select("doc_id", "n", F.explode("bands").alias("b")).select("doc_id", "n", "b.*")
    # Counts and the join read one shuffle of the tokens: both sides of it need the ids.
    rows = bands.select("doc_id", "power", F.explode("counted").alias("token")).repartition("power", "token")
    ends = [F.count(F.lit(1)).alias("found"), F.min("doc_id").alias("low"), F.max("doc_id").alias("high")]
    counts = rows.groupBy("power", "token").agg(*ends).filter("low < high").drop("low", "high")
    shared = rows.join(counts.hint("shuffle_hash"), ["power", "token"])
    lists = shared.groupBy("doc_id", "power").agg(F.collect_set(F.struct("token", "found")).alias("shared"))  # a set's tokens
    signing = bands.select("doc_id", "n", "power", F.size("counted").alias("counted_n"), "others")
    both = signing.join(lists.hint("shuffle_hash"), ["doc_id", "power"], "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            of, out = [], [np.zeros(0, np.uint64)]
            ns, powers, counted = (batch.column(c).to_pylist() for c in ("n", "power", "counted_n"))
            for row, (pairs, rest) in enumerate(zip(batch.column("shared"), batch.column("others"))):
                pairs = pairs.values
                tokens, found = (pairs.field(k).to_numpy().astype(np.int64) for k in (0, 1)) if pairs is not None else (np.zeros(0, np.int64),) * 2
                made = signatures(
                    ns[row], powers[row], counted[row], tokens.view(np.uint64), found,
                    rest.values.to_numpy().astype(np.int64).view(np.uint64), percent,
                )
                out.append(made)
                of.extend([row] * len(made))
            at = pa.array(of, pa.int64())
            flat = pa.array(np.concatenate(out).view(np.int64))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").take(at), batch.column("n").take(at), flat], names=["doc_id", "n", "signature"])

    return both.mapInArrow(run, "doc_id bigint, n bigint, signature bigint")


def whole_sets(docs: DataFrame, size: int, bits: np.ndarray | None = None) -> DataFrame:
    """(doc_id, tokens); with a bitmap only of the ids whose bit is set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordHashes()
        for batch in batches:
            if bits is not None:
                batch = batch.filter(batch.column("doc_id").is_valid())
                batch = batch.filter(pa.array(in_bitmap(batch.column("doc_id").to_numpy(), bits)))
            for start in range(0, batch.num_rows, 256):
                some = batch.slice(start, 256)
                sets = [token_set(t, size, known).view(np.int64) for t in some.column("text").to_pylist()]
                columns = [some.column("doc_id"), pa.array(sets, pa.list_(pa.int64()))]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "tokens"])

    return _read(docs).mapInArrow(run, "doc_id bigint, tokens array<bigint>")


def in_bitmap(ids: np.ndarray, bits: np.ndarray) -> np.ndarray:
    """Whether the bit of each id is set."""
    places = mixed(ids.view(np.uint64)) % np.uint64(8 * len(bits))
    return (bits[places >> np.uint64(3)] >> (places & np.uint64(7)).astype(np.uint8) & 1).astype(bool)


def bitmap(ids: DataFrame, size: int = BITMAP_BYTES) -> np.ndarray:
    """A bitmap with a bit set for every id; each task sends its bytes that aren't zero, joined before they reach the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = np.zeros(8 * size, bool)
        for batch in batches:
            own[mixed(batch.column(0).to_numpy().view(np.uint64)) % np.uint64(8 * size)] = True
        words = np.packbits(own, bitorder="little").view(np.int64)
        at = np.flatnonzero(words)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(words[at])], names=["at", "word"])

    found = ids.mapInArrow(run, "at bigint, word bigint").groupBy("at").agg(F.bit_or("word").alias("word")).toPandas()
    words = np.zeros(size // 8, np.int64)  # a row per eight bytes at most
    words[found["at"].to_numpy()] = found["word"].to_numpy()
    return words.view(np.uint8)


def member_sets(docs: DataFrame, members: DataFrame, size: int) -> DataFrame:
    """(doc_id, tokens) of the documents with these ids, one row per id.

    No text is shuffled: few ids are told to all tasks, and of many a bitmap of
    bounded size, by which most other texts are dropped where they are
    read; their sets then are joined exactly.
    """
    members = materialise(members.distinct())
    if members.count() <= BROADCAST_COPIES:
        sets = whole_sets(docs.join(F.broadcast(members), "doc_id", "left_semi"), size)
    else:
        sets = whole_sets(docs, size, bitmap(members)).join(members, "doc_id", "left_semi")
    with small_batches(docs.sparkSession):
        sets = materialise(sets)
    repeated = sets.groupBy("doc_id").agg(F.count(F.lit(1)).alias("rows")).filter("rows > 1")
    return sets if repeated.isEmpty() else materialise(sets.dropDuplicates(["doc_id"]))


def told(rows: DataFrame) -> DataFrame:
    """Stored narrow rows, for a join with sets: told to all tasks if they are few, so that the sets stay where they are."""
    return F.broadcast(rows) if rows.count() <= BROADCAST_COPIES else rows


def _may_link(n: Column, m: Column, percent: int) -> Column:
    return 100 * F.least(n, m) >= percent * F.greatest(n, m)


def close_pairs(pairs: DataFrame, marks: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b), stored, whose marks don't rule a link out; marks are (doc_id, n, mark)."""
    left = marks.select(F.col("doc_id").alias("a"), F.col("n").alias("m"), F.col("mark").alias("x"))
    right = marks.select(F.col("doc_id").alias("b"), "n", F.col("mark").alias("y")).join(told(pairs), "b")
    both = right.join(left, "a").select("a", "b", (F.col("m") + F.col("n")).alias("total"), "x", "y")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            marks = ([np.frombuffer(v, "<u8") for v in batch.column(c).to_pylist()] for c in ("x", "y"))
            close = [bool(may_be_linked(x, y, t, percent)) for x, y, t in zip(*marks, batch.column("total").to_pylist())]
            yield batch.select(["a", "b"]).filter(pa.array(close, pa.bool_()))

    return both.mapInArrow(run, "a bigint, b bigint").distinct()


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b), stored, whose sets reach the similarity; a set moves to its hub, and hubs are fewer."""
    hubs = materialise(pairs.select("a").distinct())
    left = sets.select(F.col("doc_id").alias("a"), F.col("tokens").alias("x")).join(told(hubs), "a", "left_semi")
    right = sets.select(F.col("doc_id").alias("b"), F.col("tokens").alias("y")).join(told(pairs), "b")
    both = right.join(left, "a")
    shared = F.size(F.array_intersect("x", "y"))
    judged = both.select("a", "b", shared.alias("i"), (F.size("x") + F.size("y")).alias("s"))
    return judged.filter(100 * F.col("i") >= percent * (F.col("s") - F.col("i"))).select("a", "b")


def close_sets(rows: pd.DataFrame, percent: int) -> Iterator[tuple[int, np.ndarray]]:
    """For each row of one block, or of the first of two, the places of all rows whose sets reach the similarity."""
    sides = rows["side"].tolist()
    sets = [np.asarray(t, np.int64) for t in rows["tokens"]]
    sizes = np.array([len(t) for t in sets])
    flat = np.concatenate(sets)
    owner = np.repeat(np.arange(len(sets)), sizes)
    order = np.argsort(flat, kind="stable")
    flat, owner = flat[order], owner[order]
    one_block = len(set(sides)) == 1
    for i, tokens in enumerate(sets):
        if sides[i] and not one_block:
            continue
        low, high = np.searchsorted(flat, tokens, "left"), np.searchsorted(flat, tokens, "right")
        spans = high - low
        places = np.repeat(low - np.concatenate([[0], np.cumsum(spans)[:-1]]), spans) + np.arange(spans.sum())
        shared = np.bincount(owner[places], minlength=len(sets))
        yield i, np.flatnonzero(100 * shared >= percent * (sizes + len(tokens) - shared))


def joining_links(rows: pd.DataFrame, percent: int) -> list[tuple[int, int]]:
    """Links between components of the rows of one or two blocks; at most one less than there are components."""
    ids, of = rows["doc_id"].tolist(), rows["component"].tolist()
    root = {c: c for c in of}

    def find(c):
        while root[c] != c:
            root[c] = c = root[root[c]]
        return c

    links = []
    for i, close in close_sets(rows, percent):
        for j in close:
            a, b = find(of[i]), find(of[j])
            if a != b:
                root[max(a, b)] = min(a, b)
                links.append((ids[i], ids[j]))
    return links


def near_others(rows: pd.DataFrame, percent: int) -> np.ndarray:
    """Which rows of one or two blocks have a mark that doesn't rule out a link with some row of another component."""
    sides, of, sizes = (rows[c].to_numpy() for c in ("side", "component", "n"))
    words = np.array([len(m) // 8 for m in rows["mark"]])
    first, second = (sides == 0, sides == 1) if len(set(sides)) > 1 else (np.ones(len(rows), bool),) * 2
    near = np.zeros(len(rows), bool)
    # Marks of one length are one table.
    places = {w: np.flatnonzero(second & (words == w)) for w in np.unique(words[second])}
    tables = {w: np.frombuffer(b"".join(rows["mark"].iloc[at]), "<u8").reshape(len(at), w) for w, at in places.items()}
    for w in np.unique(words[first]):
        own = np.flatnonzero(first & (words == w))
        for v, at in places.items():
            if 100 * min(sizes[own].max(), sizes[at].max()) < percent * max(sizes[own].min(), sizes[at].min()):
                continue
            table = folded(tables[v], w)
            for i in own:
                mark = np.frombuffer(rows["mark"].iat[i], "<u8")
                close = at[may_be_linked(table, mark, sizes[at] + sizes[i], percent) & (of[at] != of[i])]
                near[close] = True
                near[i] |= len(close) > 0
    return near


def open_rows(open_: DataFrame, marks: DataFrame, percent: int) -> DataFrame:
    """(part, doc_id, n, component), stored, of the sets that may be linked with a set of another component.

    `open_` has (signature, doc_id, n, component). Signatures with the same
    lowest component are one part, so that a pair isn't compared once per
    signature. A set that no mark in its part comes near to has no link there.
    """
    lowest = open_.groupBy("signature").agg(F.min("component").alias("part"))
    rows = materialise(open_.join(lowest, "signature").select("part", "doc_id", "n", "component").distinct())

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        return rows.loc[near_others(rows, percent), ["part", "doc_id"]]

    near = _cells(rows, marks).groupBy("part", "first", "second").applyInPandas(run, "part bigint, doc_id bigint")
    return materialise(rows.join(told(materialise(near.distinct())), ["part", "doc_id"], "left_semi"))


def links_across(rows: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) between components among the sets of one part.

    `rows` has (part, doc_id, n, component). A part is cut into blocks of
    bounded sets and tokens, and any two of them are a cell.
    """
    cells = _cells(rows, sets)

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame(joining_links(rows, percent), columns=["a", "b"], dtype="int64")

    return cells.groupBy("part", "first", "second").applyInPandas(run, "a bigint, b bigint")


def _cells(rows: DataFrame, sets: DataFrame) -> DataFrame:
    """Rows (part, doc_id, n, component) with their tokens or marks, once per cell: two blocks, or one, of a part."""
    enough = F.greatest(F.ceil(F.count(F.lit(1)) / BLOCK), F.ceil(F.sum("n") / BLOCK_TOKENS))
    blocks = rows.groupBy("part").agg(enough.cast("int").alias("blocks"))
    dealt = rows.join(blocks, "part").withColumn("block", F.pmod(F.xxhash64("doc_id"), F.col("blocks")).cast("int"))
    others = F.sequence(F.lit(0), F.col("blocks") - 1)
    spread = dealt.withColumn("other", F.explode(others)).select(
        "part", F.least("block", "other").alias("first"), F.greatest("block", "other").alias("second"),
        (F.col("block") > F.col("other")).cast("int").alias("side"), "doc_id", "component",
    )
    return sets.join(told(materialise(spread)), "doc_id")


def ngram_components(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, class_id (smallest id with the same set) and component_id."""
    with small_batches(docs.sparkSession):
        signed = materialise(signed_sets(docs, size, percent))
    classes = materialise(signed.groupBy("hi", "lo", "n").agg(F.min("doc_id").alias("class_id"), F.count(F.lit(1)).alias("copies")))

    several = classes.filter("copies > 1").select("hi", "lo", "class_id")
    copies = signed.select("doc_id", "hi", "lo").join(several, ["hi", "lo"]).filter("doc_id <> class_id").select("doc_id")
    copies = materialise(copies.distinct())
    if copies.count() <= BROADCAST_COPIES:
        copies = F.broadcast(copies)
    heads = signed.filter("n > 1 AND doc_id IS NOT NULL").join(copies, "doc_id", "left_anti")
    index = materialise(signature_index(heads, percent).distinct())

    hubs = index.groupBy("signature").agg(F.min(F.struct("doc_id", "n")).alias("hub"), F.count(F.lit(1)).alias("size"))
    hubs = hubs.filter("size > 1").select("signature", F.col("hub.doc_id").alias("hub"), F.col("hub.n").alias("hub_n"), "size")
    shared = materialise(index.join(hubs, "signature"))
    star = shared.filter(F.col("doc_id") != F.col("hub")).filter(_may_link(F.col("n"), F.col("hub_n"), percent))
    star = materialise(star.select(F.col("hub").alias("a"), F.col("doc_id").alias("b")).distinct())
    members = materialise(shared.filter("size > 2").select("doc_id").union(star.select("a")).union(star.select("b")).distinct())
    marks = materialise(heads.select("doc_id", "n", "mark").join(told(members), "doc_id", "left_semi").distinct())
    star = materialise(close_pairs(star, marks, percent))
    links = materialise(verified(star, member_sets(docs, star.select(F.col("a").alias("doc_id")).union(star.select("b")), size), percent))
    found = components(links)

    # Pairs that no hub settled: sets of one signature in different components.
    labelled = shared.filter("size > 2").join(found.withColumnRenamed("id", "doc_id"), "doc_id", "left")
    labelled = labelled.select("signature", "doc_id", "n", F.coalesce("component", "doc_id").alias("component"))
    split = labelled.groupBy("signature").agg(F.min("component").alias("low"), F.max("component").alias("high"))
    open_ = materialise(labelled.join(split.filter("low <> high").select("signature"), "signature"))
    rows = open_rows(open_, marks, percent)
    more = materialise(links_across(rows, member_sets(docs, rows.select("doc_id"), size), percent))
    found = components(links.union(more))

    of_class = classes.join(found.withColumnRenamed("id", "class_id"), "class_id", "left").select(
        "hi", "lo", "class_id", F.coalesce("component", "class_id").alias("component_id"), (F.col("n") == 0).alias("empty")
    )
    out = signed.select("doc_id", "n", "hi", "lo").join(of_class, ["hi", "lo"])
    alone = lambda c: F.when(F.col("empty"), F.col("doc_id")).otherwise(F.col(c)).alias(c)
    return out.select("doc_id", F.col("n").alias("n_shingles"), alone("class_id"), alone("component_id"))


def _component_cells(docs: DataFrame, size: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """The representatives of all classes that have n-grams, and those of components of several classes in cells."""
    found = materialise(ngram_components(docs, size, percent))
    heads = found.filter("doc_id = class_id AND n_shingles > 0")
    heads = materialise(heads.select("doc_id", F.col("n_shingles").alias("n"), F.col("component_id").alias("component")).distinct())
    several = heads.groupBy("component").agg(F.count(F.lit(1)).alias("classes")).filter("classes > 1").select("component")
    rows = materialise(heads.join(several, "component").select(F.col("component").alias("part"), "doc_id", "n", "component"))
    return heads, _cells(rows, member_sets(docs, rows.select("doc_id"), size))


def _links_of_cell(rows: pd.DataFrame, percent: int) -> Iterator[tuple[int, np.ndarray]]:
    """For each row the places of the rows it is linked with, so that a cell names each pair once."""
    sides = rows["side"].to_numpy()
    one_block = len(set(sides)) == 1
    for i, close in close_sets(rows, percent):
        yield i, close[close > i] if one_block else close[sides[close] == 1]


def class_links(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """(a, b), a < b: all pairs of class representatives whose sets reach the similarity, each verified.

    Both ends of a link are in one component, so each component is cut into
    blocks and any two of them are compared in full. A group of k near copies
    with different texts has k * (k - 1) / 2 links; `link_counts` gives their
    number without returning the pairs.
    """
    _, cells = _component_cells(docs, size, percent)

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        ids, ends = rows["doc_id"].to_numpy(), [np.zeros((0, 2), np.int64)]
        for i, close in _links_of_cell(rows, percent):
            ends.append(np.stack([np.full(len(close), ids[i]), ids[close]], axis=1))
        pairs = np.concatenate(ends)
        return pd.DataFrame({"a": pairs.min(axis=1), "b": pairs.max(axis=1)})

    return cells.groupBy("part", "first", "second").applyInPandas(run, "a bigint, b bigint")


def link_counts(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """(doc_id, n_links): per class representative the classes it is linked with, 0 included; summed per cell first."""
    heads, cells = _component_cells(docs, size, percent)

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        counts = np.zeros(len(rows), np.int64)
        for i, close in _links_of_cell(rows, percent):
            counts[i] += len(close)
            counts[close] += 1
        return pd.DataFrame({"doc_id": rows["doc_id"], "found": counts})

    counts = cells.groupBy("part", "first", "second").applyInPandas(run, "doc_id bigint, found bigint")
    counts = counts.groupBy("doc_id").agg(F.sum("found").alias("found"))
    return heads.join(counts, "doc_id", "left").select("doc_id", F.coalesce("found", F.lit(0)).cast("long").alias("n_links"))


def keep_first(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """One document of each component, the one with the smallest id, with the columns it came with.

    Of rows that repeat an id one stays; documents without an id all stay.
    """
    found = materialise(ngram_components(docs, size, percent).select("doc_id", "component_id"))
    heads = found.filter("doc_id = component_id").groupBy("doc_id").agg(F.count(F.lit(1)).alias("rows"))
    repeated = materialise(heads.filter("rows > 1").select("doc_id"))
    some = not repeated.isEmpty()
    gone = found.filter("doc_id <> component_id").select("doc_id")
    gone = materialise((gone.union(repeated) if some else gone).distinct())
    # Few ids are told to all tasks, and no text is shuffled.
    gone = F.broadcast(gone) if gone.count() <= BROADCAST_COPIES else gone.hint("shuffle_hash")
    kept = docs.join(gone, "doc_id", "left_anti")
    if some:
        kept = kept.unionByName(docs.join(repeated, "doc_id", "left_semi").dropDuplicates(["doc_id"]))
    return kept.select(*[F.col(f"`{c}`") for c in docs.columns])
