"""Cross-tokenizer alignment: which tokens of two tokenizers cover the same bytes.

The ends of a text's A tokens and of its B tokens are two rising lists of byte
offsets. Where both have the same end the text is cut, and all A and B tokens between
two cuts are a group and linked with each other. Merging two lists takes as many steps as
there are tokens; a binary search along the diagonal `i + j = d` finds how many of the
first d steps come from either list. So a text is divided into pieces of
`PIECE` steps each without merging anything, and pieces are merged independently. A
text of one piece is finished where it was read. The pieces of longer texts are
dealt out as rows of their own, emit the links of the groups that lie whole inside
them, and their open ends, which are stitched per text.

How many documents hold a pair of ids linked is counted over the distinct
pairs of each document. The counts go back to the documents by broadcast for at
most `FREQUENT` pairs, those with the highest counts; the other pairs, none of which is
in many documents, are joined by a shuffle. The highest count per A id is a table no longer than
the vocabulary.

Defined results: a null or empty text, and one that either tokenizer does not
give back byte by byte, has no tokens, zeros and an empty digest; strings of special tokens are
plain text; rows are told apart by their place, so repeated ids and rows count as documents of their own,
null ids too; ids with equal counts are all best; an empty table gives an empty table;
very long texts are whole rows, whose memory is that of one text and its distinct pairs; further columns are ignored.
"""

from __future__ import annotations

import functools
import hashlib
import json
import re
from array import array
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripflow.llm.tokens import byte_letters, in_parts, load_tokenizer
from tripflow.session import materialise, shuffle_parts

# Steps of a merge (A and B tokens) in a piece.
PIECE = 16_384
# Pairs whose counts are broadcast, at most.
FREQUENT = 100_000
# Bytes of text that are aligned in one go, and words that a worker remembers.
TEXT_BYTES = 2 << 20
REMEMBERED = 400_000
# Groups with more links than this are multiplied by distinct ids.
BIG_GROUP = 10_000

BLANK = "▁"
# How a byte-level pre-tokenizer cuts texts: a fixed pattern.
BYTE_LEVEL = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# Beyond Latin, Greek and Cyrillic letters and common marks.
RARE = re.compile("[^\0-\u052f\u2000-\u206f\u20ac]")


class Vocabulary:
    """The bytes of every id."""

    def __init__(self, entries: list[bytes]):
        self.lengths = np.array([len(e) for e in entries], np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.flat = np.frombuffer(b"".join(entries), np.uint8)

    def __len__(self) -> int:
        return len(self.lengths)

    def joined(self, ids: np.ndarray) -> np.ndarray:
        """The bytes of ids in a row."""
        n = self.lengths[ids]
        after = np.cumsum(n)
        return self.flat[np.repeat(self.starts[ids] - (after - n), n) + np.arange(after[-1] if len(after) else 0)]


def first_entries(data: str) -> list[bytes]:
    """The bytes of every id of a byte-level tokenizer file."""
    letters = {letter: byte for byte, letter in byte_letters().items()}
    file = json.loads(data)
    ids = {**file["model"]["vocab"], **{t["content"]: t["id"] for t in file["added_tokens"]}}
    entries = [b""] * (max(ids.values()) + 1)
    for token, i in ids.items():
        entries[i] = bytes(letters[c] for c in token) if all(c in letters for c in token) else token.encode()
    return entries


def second_entries(model: bytes) -> list[bytes]:
    """The bytes of every id of a piece model."""
    import sentencepiece

    loaded = sentencepiece.SentencePieceProcessor(model_proto=model)
    pieces = [loaded.id_to_piece(i) for i in range(loaded.get_piece_size())]
    return [bytes([int(p[3:5], 16)]) if loaded.is_byte(i) else p.replace(BLANK, " ").encode() for i, p in enumerate(pieces)]


class FirstTokens:
    """A space and the text by a byte-level tokenizer file.

    Where the ids rise in the order of the merges they are the ranks that another
    library merges by, twice as fast; it gets the texts of letters
    and marks whose classes all versions of Unicode agree on. Bytes are always given back.
    """

    def __init__(self, data: str):
        file = json.loads(data)
        self.data = data
        merges = [m if isinstance(m, str) else " ".join(m) for m in file["model"]["merges"]]
        made = [file["model"]["vocab"][m.replace(" ", "")] for m in merges]
        kind = file["pre_tokenizer"] or {}
        self.ranked = made == sorted(made) and kind.get("type") == "ByteLevel" and kind.get("use_regex", True) and not file["normalizer"]
        if self.ranked:
            import tiktoken

            special = {t["id"] for t in file["added_tokens"]}
            ranks = {e: i for i, e in enumerate(first_entries(data)) if i not in special}
            self.ranks = tiktoken.Encoding("ranks", pat_str=BYTE_LEVEL, mergeable_ranks=ranks, special_tokens={})

    @functools.cached_property
    def library(self):
        from tokenizers import Tokenizer

        loaded = Tokenizer.from_str(self.data)
        loaded.encode_special_tokens = True  # their strings are plain text
        return loaded

    def encode(self, texts: list[str]) -> list[np.ndarray | None]:
        """The ids of every text; None for an empty one."""
        out: list[np.ndarray | None] = []
        for text in texts:
            if not text:
                out.append(None)
            elif self.ranked and not RARE.search(text):
                out.append(np.array(self.ranks.encode_ordinary(" " + text), np.int64))
            else:
                out.append(np.array(self.library.encode(" " + text, add_special_tokens=False).ids, np.int64))
        return out


class SecondTokens:
    """Texts by a piece model, which adds the space.

    No piece crosses a single blank, so words are encoded one by one and remembered. A word
    that its ids don't give back sends its text the slow way, whole.
    """

    def __init__(self, model: bytes):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.vocabulary = Vocabulary(second_entries(model))
        pieces = [self.model.id_to_piece(i) for i in range(len(self.vocabulary))]
        self.by_words = not any(BLANK in p[1:] and p.strip(BLANK) for p in pieces)
        self.known: dict[str, bytes | None] = {}

    def _learn(self, words: list[str]) -> None:
        ids = [array("I", i).tobytes() for i in self.model.encode(words, num_threads=1)]
        if self.vocabulary.joined(np.frombuffer(b"".join(ids), "<u4")).tobytes() == "".join(" " + w for w in words).encode():
            self.known.update(zip(words, ids))
            return
        for word, own in zip(words, ids):
            self.known[word] = own if self.vocabulary.joined(np.frombuffer(own, "<u4")).tobytes() == (" " + word).encode() else None

    def encode(self, texts: list[str]) -> list[np.ndarray | None]:
        """The ids of every text, or None for one that is empty or that its tokens don't give back."""
        lists = [t.split(" ") for t in texts]
        lists = [w if self.by_words and "" not in w and BLANK not in t else [] for w, t in zip(lists, texts)]
        wanted = {w for words in lists for w in words}
        new = wanted.difference(self.known)
        if len(self.known) + len(new) > REMEMBERED:
            self.known, new = {}, wanted
        self._learn(list(new))
        out: list[np.ndarray | None] = []
        for text, words in zip(texts, lists):
            coded = [self.known[w] for w in words]
            if text and coded and None not in coded:
                out.append(np.frombuffer(b"".join(coded), "<u4").astype(np.int64))
                continue
            ids = np.array(self.model.encode(text, num_threads=1), np.int64)
            out.append(ids if text and self.vocabulary.joined(ids).tobytes() == (" " + text).encode() else None)
        return out


def diagonal(ends_a: np.ndarray, ends_b: np.ndarray, d: int) -> tuple[int, int]:
    """How many of the first d steps of the merge come from either list; an end of both is never divided."""
    low, high = max(0, d - len(ends_b)), min(d, len(ends_a))
    while low < high:
        middle = (low + high) // 2
        if ends_a[middle] <= ends_b[d - 1 - middle]:
            low = middle + 1
        else:
            high = middle
    i, j = low, d - low
    return i, j + int(0 < i and j < len(ends_b) and ends_a[i - 1] == ends_b[j])


def cuts(ends_a: np.ndarray, ends_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """How many A and B tokens lie before each common end."""
    at = np.searchsorted(ends_b, ends_a)
    common = np.flatnonzero(at < len(ends_b))
    common = common[ends_b[at[common]] == ends_a[common]]
    return common + 1, at[common] + 1


@dataclass
class Links:
    """Distinct pairs per owner, with how often each is linked; rows of owner k are first[k] to first[k + 1]."""

    pairs: np.ndarray
    times: np.ndarray
    first: np.ndarray


def link(a: np.ndarray, b: np.ndarray, cut_a: np.ndarray, cut_b: np.ndarray, owner: np.ndarray, owners: int, space: tuple[int, int]) -> Links:
    """The links of groups that end at the cuts; `owner` has the text of each group, `space` the sizes of the vocabularies."""
    n_a, n_b = np.diff(cut_a, prepend=0), np.diff(cut_b, prepend=0)
    start_a, start_b = cut_a - n_a, cut_b - n_b
    big = n_a * n_b > BIG_GROUP
    group = np.repeat(np.arange(len(n_a)), n_a)
    times = np.where(big, 0, n_b)[group]
    total = int(times.sum())
    within = np.arange(total) - np.repeat(np.cumsum(times) - times, times)
    whole = space[0] * space[1]
    keys = np.repeat(owner[group] * whole + a[: len(group)] * space[1], times) + b[np.repeat(start_b[group], times) + within]
    keys, counts = np.unique(keys, return_counts=True)
    if big.any():
        parts, weights = [keys], [counts]
        for g in np.flatnonzero(big):
            ids_a, times_a = np.unique(a[start_a[g] : cut_a[g]], return_counts=True)
            ids_b, times_b = np.unique(b[start_b[g] : cut_b[g]], return_counts=True)
            parts.append((owner[g] * whole + ids_a[:, None] * space[1] + ids_b).ravel())
            weights.append(np.multiply.outer(times_a, times_b).ravel())
        keys, place = np.unique(np.concatenate(parts), return_inverse=True)
        counts = np.zeros(len(keys), np.int64)
        np.add.at(counts, place, np.concatenate(weights))
    return Links(keys % whole, counts, np.searchsorted(keys, np.arange(owners + 1) * whole))


class Writer:
    """Groups as text: A ids, a bar and B ids, groups apart by semicolons."""

    def __init__(self, most: int):
        told = np.array([f"{i}{mark}".encode() for i in range(most) for mark in ",|;"])
        self.table = told.view(np.uint8).reshape(len(told), -1)  # short entries are filled with zeros

    def marked(self, a: np.ndarray, b: np.ndarray, cut_a: np.ndarray, cut_b: np.ndarray) -> np.ndarray:
        """Ids of both lists in the order in which they are written, each with the mark that follows it."""
        n_a, n_b = np.diff(cut_a, prepend=0), np.diff(cut_b, prepend=0)
        out = np.empty(len(a) + len(b), np.int64)
        mark_a, mark_b = np.zeros(len(a), np.int64), np.zeros(len(b), np.int64)
        mark_a[cut_a - 1], mark_b[cut_b - 1] = 1, 2
        out[np.arange(len(a)) + np.repeat(cut_b - n_b, n_a)] = 3 * a + mark_a
        out[np.arange(len(b)) + np.repeat(cut_a, n_b)] = 3 * b + mark_b
        return out

    def text(self, marked: np.ndarray) -> bytes:
        told = self.table[marked]
        return told[told != 0].tobytes()


class Aligner:
    """Alignment of texts and pieces, given how many bytes every id stands for."""

    def __init__(self, lengths_a: np.ndarray, lengths_b: np.ndarray, piece: int):
        self.lengths_a, self.lengths_b, self.piece = lengths_a, lengths_b, piece
        self.space = len(lengths_a), len(lengths_b)
        self.writer = Writer(max(self.space))

    def _finished(self, a: list[np.ndarray], b: list[np.ndarray]) -> list[dict]:
        """The results of texts of one piece: laid end to end, they share no group, since all texts end in both lists."""
        whole_a, whole_b = np.concatenate(a), np.concatenate(b)
        cut_a, cut_b = cuts(np.cumsum(self.lengths_a[whole_a]), np.cumsum(self.lengths_b[whole_b]))
        end_a, end_b = np.cumsum([len(x) for x in a]), np.cumsum([len(x) for x in b])
        last = np.searchsorted(cut_a, end_a)  # the last group of each text
        n_groups = np.diff(last, prepend=-1)
        owner = np.repeat(np.arange(len(a)), n_groups)
        links = link(whole_a, whole_b, cut_a, cut_b, owner, len(a), self.space)
        n_links = np.add.reduceat(np.diff(cut_a, prepend=0) * np.diff(cut_b, prepend=0), last - n_groups + 1)
        marked = self.writer.marked(whole_a, whole_b, cut_a, cut_b)
        out, at = [], 0
        for k, end in enumerate((end_a + end_b).tolist()):
            x, y = links.first[k], links.first[k + 1]
            out.append({
                "n_a": len(a[k]), "n_b": len(b[k]), "n_groups": int(n_groups[k]), "n_links": int(n_links[k]),
                "groups": self.writer.text(marked[at:end])[:-1], "pairs": links.pairs[x:y], "times": links.times[x:y],
            })
            at = end
        return out

    def _pieces(self, a: np.ndarray, b: np.ndarray) -> Iterator[dict]:
        """A long text in pieces of equal work."""
        ends_a, ends_b = np.cumsum(self.lengths_a[a]), np.cumsum(self.lengths_b[b])
        bounds = [diagonal(ends_a, ends_b, d) for d in range(0, len(a) + len(b), self.piece)] + [(len(a), len(b))]
        for k, ((i, j), (to_i, to_j)) in enumerate(zip(bounds, bounds[1:])):
            yield {
                "n_a": to_i - i, "n_b": to_j - j, "piece": k, "pieces": len(bounds) - 1,
                "a": a[i:to_i].astype("<u4").tobytes(), "b": b[j:to_j].astype("<u4").tobytes(),
                "before_a": int(ends_a[i - 1]) if i else 0, "before_b": int(ends_b[j - 1]) if j else 0,
            }

    def texts(self, a: list[np.ndarray | None], b: list[np.ndarray | None]) -> Iterator[tuple[int, dict]]:
        """(place of the text, result or piece) from the ids of texts."""
        sound = [x is not None and y is not None for x, y in zip(a, b)]
        short = [k for k, good in enumerate(sound) if good and len(a[k]) + len(b[k]) <= self.piece]
        if short:
            yield from zip(short, self._finished([a[k] for k in short], [b[k] for k in short]))
        for k, good in enumerate(sound):
            if not good:
                yield k, {"n_a": 0, "n_b": 0, "n_groups": 0, "n_links": 0}
            elif len(a[k]) + len(b[k]) > self.piece:
                yield from ((k, p) for p in self._pieces(a[k], b[k]))

    def merged(self, row: dict) -> dict:
        """One piece: the groups whole inside it, and the tokens before its first and behind its last common end."""
        a, b = (np.frombuffer(row[c], "<u4").astype(np.int64) for c in "ab")
        cut_a, cut_b = cuts(
            row["before_a"] + np.cumsum(self.lengths_a[a]), row["before_b"] + np.cumsum(self.lengths_b[b])
        )
        closed = len(cut_a) > 0
        # A text begins with a cut; any other piece may begin inside a group.
        x, y = (0, 0) if row["piece"] == 0 else (cut_a[0], cut_b[0]) if closed else (len(a), len(b))
        to_x, to_y = (cut_a[-1], cut_b[-1]) if closed else (x, y)
        inner_a, inner_b = cut_a[cut_a > x] - x, cut_b[cut_a > x] - y
        links = link(a[x:to_x], b[y:to_y], inner_a, inner_b, np.zeros(len(inner_a), np.int64), 1, self.space)
        return {
            "closed": closed, "n_groups": len(inner_a), "n_links": int((np.diff(inner_a, prepend=0) * np.diff(inner_b, prepend=0)).sum()),
            "groups": self.writer.text(self.writer.marked(a[x:to_x], b[y:to_y], inner_a, inner_b)), "pairs": links.pairs.tobytes(), "times": links.times.tobytes(),
            "head_a": a[:x].tobytes(), "head_b": b[:y].tobytes(), "tail_a": a[to_x:].tobytes(), "tail_b": b[to_y:].tobytes(),
        }

    def stitched(self, pieces: list[dict]) -> dict:
        """The result of a text from its pieces, in order."""
        text, pairs, times = [], [], []
        n_groups = n_links = n_a = n_b = 0
        open_a, open_b = b"", b""
        for p in pieces:
            open_a, open_b = open_a + p["head_a"], open_b + p["head_b"]
            n_a, n_b = n_a + p["n_a"], n_b + p["n_b"]
            if p["closed"]:
                if open_a or open_b:
                    a, b = np.frombuffer(open_a, np.int64), np.frombuffer(open_b, np.int64)
                    ends = np.array([len(a)]), np.array([len(b)])
                    across = link(a, b, *ends, np.zeros(1, np.int64), 1, self.space)
                    text.append(self.writer.text(self.writer.marked(a, b, *ends)))
                    pairs.append(across.pairs)
                    times.append(across.times)
                    n_groups, n_links = n_groups + 1, n_links + len(a) * len(b)
                open_a, open_b = b"", b""
                text.append(p["groups"])
                pairs.append(np.frombuffer(p["pairs"], np.int64))
                times.append(np.frombuffer(p["times"], np.int64))
                n_groups, n_links = n_groups + p["n_groups"], n_links + p["n_links"]
            open_a, open_b = open_a + p["tail_a"], open_b + p["tail_b"]
        ids, place = np.unique(np.concatenate(pairs), return_inverse=True)
        summed = np.zeros(len(ids), np.int64)
        np.add.at(summed, place, np.concatenate(times))
        return {
            "n_a": n_a, "n_b": n_b, "n_groups": n_groups, "n_links": n_links, "groups": b"".join(text)[:-1], "pairs": ids, "times": summed,
        }


NUMBERS = "row long, n_a long, n_b long, n_groups long, n_links long, groups binary"
LISTS = "pairs array<long>, times array<int>"
TEXT_ROWS = f"{NUMBERS}, {LISTS}, piece int, pieces int, a binary, b binary, before_a long, before_b long"
PIECE_ROWS = f"{NUMBERS}, pairs binary, times binary, piece int, closed boolean, head_a binary, head_b binary, tail_a binary, tail_b binary"


def _batch(rows: list[dict], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r.get(f.name) for r in rows], f.type) for f in schema], schema=schema)


def _arrow(schema: str) -> pa.Schema:
    kinds = {
        "long": pa.int64(), "int": pa.int32(), "binary": pa.binary(), "boolean": pa.bool_(),
        "array<int>": pa.list_(pa.int32()), "array<long>": pa.list_(pa.int64()),
    }
    return pa.schema([(n, kinds[k]) for n, k in (part.split() for part in schema.split(", "))])


@dataclass(frozen=True)
class Tokenizers:
    """The files of both tokenizers, read by the driver, and the bytes per id: some megabytes at most."""

    first: str
    second: bytes
    lengths_a: np.ndarray
    lengths_b: np.ndarray
    piece: int = PIECE

    @staticmethod
    def load(first: str, second: str, piece: int = PIECE) -> Tokenizers:
        data = load_tokenizer(first)
        with open(second, "rb") as file:
            model = file.read()
        return Tokenizers(data, model, Vocabulary(first_entries(data)).lengths, Vocabulary(second_entries(model)).lengths, piece)


def _finish(result: dict, whole: bool) -> dict:
    """The groups as text, or only their digest."""
    groups = result.get("groups")
    return result | {"groups": groups if whole or not groups else hashlib.sha256(groups).hexdigest().encode()}


def align(docs: DataFrame, tokenizers: Tokenizers, text: str = "text", whole: bool = False) -> DataFrame:
    """One row per document with its number `row`, its id, counts, groups, and the distinct linked pairs with how often each is linked.

    A pair is A id times the size of the B vocabulary plus B id. `groups` is the
    text of the groups if `whole`, or its SHA-256 in hexadecimal.
    """
    numbered = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", F.col(f"`{text}`").alias("text"))
    kind = docs.schema["doc_id"].dataType
    first = T._parse_datatype_string(TEXT_ROWS)

    sizes = tokenizers.lengths_a, tokenizers.lengths_b, tokenizers.piece

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner, schema = Aligner(*sizes), _arrow(TEXT_ROWS)
        first, second = FirstTokens(tokenizers.first), SecondTokens(tokenizers.second)
        for batch in batches:
            for part in in_parts(batch, most=TEXT_BYTES):
                numbers, ids = part.column("row").to_pylist(), part.column("doc_id")
                texts = pc.fill_null(part.column("text"), "").to_pylist()
                found = list(aligner.texts(first.encode(texts), second.encode(texts)))
                rows = [_finish(r, whole) | {"row": numbers[k]} for k, r in found]
                out = _batch(rows, schema)
                of = ids.take(pa.array([int(k) for k, _ in found], pa.int64()))
                yield pa.RecordBatch.from_arrays([*out.columns, of], names=[*out.schema.names, "doc_id"])

    texts = materialise(numbered.mapInArrow(read, T.StructType([*first.fields, T.StructField("doc_id", kind)])))

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner, schema = Aligner(*sizes), _arrow(PIECE_ROWS)
        for batch in batches:
            for row in batch.to_pylist():
                yield _batch([row | aligner.merged(row)], schema)

    def stitch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner, schema = Aligner(*sizes), _arrow(f"{NUMBERS}, {LISTS}")
        for batch in batches:
            for row in batch.to_pylist():
                yield _batch([_finish(aligner.stitched(row["of"]), whole) | {"row": row["row"]}], schema)

    pieces = texts.filter("pieces > 1").drop("doc_id").repartition(shuffle_parts(docs.sparkSession), "row", "piece")
    merged = pieces.mapInArrow(merge, PIECE_ROWS)
    order = ["piece", *(c for c in merged.columns if c not in ("row", "piece"))]
    long = merged.groupBy("row").agg(F.sort_array(F.collect_list(F.struct("piece", F.struct(*order[1:]).alias("of")))).alias("of"))
    long = long.select("row", F.transform("of", lambda p: p["of"]).alias("of")).mapInArrow(stitch, f"{NUMBERS}, {LISTS}")
    ids = texts.filter("piece = 0").select("row", "doc_id")
    columns = ["row", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups", "pairs", "times"]
    long = materialise(long.join(ids, "row").select(*columns))
    return texts.filter("pieces IS NULL").select(*columns).unionByName(long)


def pair_counts(aligned: DataFrame, width: int) -> DataFrame:
    """How many documents hold each pair linked, and whether no pair of its A id is in more; `width` is the size of the B vocabulary."""
    counts = aligned.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count(F.lit(1)).alias("docs"))
    counts = materialise(counts.withColumn("of", F.expr(f"pair div {width}")))
    best = counts.groupBy(F.col("of").alias("best_of")).agg(F.max("docs").alias("most"))  # a row per id of the A vocabulary
    found = counts.join(F.broadcast(best), F.col("of") == F.col("best_of"))
    return found.select("pair", "docs", (F.col("docs") == F.col("most")).alias("best"))


def frequent_bound(counts: DataFrame, most: int = FREQUENT) -> int:
    """The lowest count from which on there are at most `most` pairs, to an eighth of a power of two."""
    step = F.floor(F.log2("docs") * 8).cast("int").alias("step")
    steps = counts.groupBy(step).agg(F.count(F.lit(1)).alias("n"), F.min("docs").alias("low"))  # some hundred rows
    bound, n = 1 << 62, 0
    for row in steps.orderBy(F.desc("step")).collect():
        n += row["n"]
        if n > most:
            break
        bound = row["low"]
    return bound


def link_sums(aligned: DataFrame, counts: DataFrame, most: int = FREQUENT) -> DataFrame:
    """Per document number: its links whose pair is the most frequent one of its A id, and the counts of all its links added up."""
    bound = frequent_bound(counts, most)
    often = F.broadcast(counts.filter(F.col("docs") >= bound))  # at most `most` rows
    links = aligned.select("row", F.inline(F.arrays_zip("pairs", "times"))).withColumnRenamed("pairs", "pair")
    sums: Callable[[DataFrame], DataFrame] = lambda df: df.groupBy("row").agg(
        F.sum(F.when(F.col("best"), F.col("times").cast("long")).otherwise(0)).alias("n_best"),
        F.sum(F.col("times") * F.col("docs")).alias("count_sum"),
    )
    rest = links.join(often.select("pair"), "pair", "left_anti")
    both = sums(links.join(often, "pair")).unionByName(sums(rest.join(counts.filter(F.col("docs") < bound), "pair")))
    return both.groupBy("row").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))


def align_and_count(docs: DataFrame, tokenizers: Tokenizers, text: str = "text", whole: bool = False) -> DataFrame:
    """Documents with their counts, groups, and the corpus-wide counts of their links."""
    aligned = align(docs, tokenizers, text, whole)
    counts = pair_counts(aligned, len(tokenizers.lengths_b))
    sums = link_sums(aligned, materialise(counts))
    numbers = aligned.drop("pairs", "times").join(sums, "row", "left")
    return numbers.select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links",
        *(F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("n_best", "count_sum")),
        F.coalesce(F.col("groups").cast("string"), F.lit("")).alias("groups"),
    )
