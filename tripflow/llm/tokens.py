"""Token ids of whole texts by a public tokenizer file of the tokenizers library.

A byte-level BPE never merges across the places where its pattern cuts a text,
and it cuts before every space that is followed by a visible character, and on
both sides of a single line break between visible ones. So the ids of a text
are those of its words in a row. The words of a batch are told apart by
Arrow, each is encoded once, and the ids of the texts are gathered by place.
A worker also remembers the ids of the first words it meets, up to a bound.
Latin words go straight to the library's BPE model, a mark behind them apart;
other words, and texts with other white space, go through the whole tokenizer.
All ways give the ids that the library gives for the whole text; where the
tokenizer isn't of this kind, every text is encoded whole.
"""

from __future__ import annotations

import re
import sys
import types
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Words whose ids a worker remembers, words encoded as one text, and texts gathered at once.
REMEMBERED = 200_000
AT_ONCE = 4_000
TEXTS = 1_000
# Bytes of text that are encoded in one go.
MAX_BYTES = 16 << 20

LATIN = "[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f]+"
MARKS = ".,;:!?"
# Blanks next to each other or at an end, and any blank but space and line break.
OTHER_BLANKS = (
    r"[ \n][ \n]|\A[ \n]|[ \n]\z|[\t\v\f\r\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
    r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
)


def byte_letters() -> dict[int, str]:
    """The letter by which a byte-level BPE names each byte: itself if it can be seen, else the next free one from 256."""
    seen = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in seen]
    return {**{b: chr(b) for b in seen}, **{b: chr(256 + i) for i, b in enumerate(rest)}}


class Encoder:
    """Texts to ids, as little-endian unsigned integers of `width` bytes."""

    def __init__(self, data: str, width: int = 4):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(data)
        self.model = self.tokenizer.model
        self.dtype, self.code = np.dtype(f"<u{width}"), {2: "H", 4: "I"}[width]
        self.known: dict[str, bytes] = {}
        self.latin, self.letters = re.compile(LATIN), byte_letters()
        self.line_break = self._plain("\n")
        parts = [self._plain(x) for x in ("a", " b", "\n", "c", ".", " d\u00e9")]
        self.by_words = self._plain("a b\nc. d\u00e9") == b"".join(parts) and self._direct(" d\u00e9") == parts[-1]

    def _plain(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, self.dtype).tobytes()

    def _direct(self, word: str) -> bytes:
        """Ids of letters that the pattern keeps together, with the space before them."""
        named = word.encode().decode("latin-1").translate(self.letters)
        return array(self.code, [t.id for t in self.model.tokenize(named)]).tobytes()

    def _learn(self, words: list[str]) -> dict[str, bytes]:
        """Ids of words; a word is a line break and a first word, or any other, which a space precedes."""
        out: dict[str, bytes] = {}
        marks: dict[str, bytes] = {"": b""}
        odd: dict[bool, list[str]] = {True: [], False: []}
        for word in words:
            first = word[:1] == "\n"
            stem = word.rstrip(MARKS)
            if not self.latin.fullmatch(stem, 1 if first else 0):
                odd[first].append(word)
                continue
            ids = self.known.get(stem) or out.get(stem)
            if ids is None:
                ids = self.line_break + self._direct(stem[1:]) if first else self._direct(" " + stem)
                out[stem] = ids
            tail = word[len(stem) :]
            if tail not in marks:
                marks[tail] = self._plain(tail)
            out[word] = ids + marks[tail]
        for first, chosen in odd.items():
            for i in range(0, len(chosen), AT_ONCE):
                some = chosen[i : i + AT_ONCE]
                coded = self._plain("".join(some)[1:] if first else " " + "\n ".join(some))
                ids = np.frombuffer(coded, self.dtype)
                ends = np.flatnonzero(ids == np.frombuffer(self.line_break, self.dtype)[0])
                starts = [0, *(ends + 1).tolist()]
                head = self.line_break if first else b""
                for word, a, b in zip(some, starts, [*ends.tolist(), len(ids)], strict=True):
                    out[word] = head + ids[a:b].tobytes()
        return out

    def _remember(self, learned: dict[str, bytes]) -> None:
        for word, ids in learned.items():
            if len(self.known) >= REMEMBERED:
                break
            self.known[word] = ids

    def encode(self, texts: pa.Array) -> list[bytes]:
        """The ids of each text; null is an empty text."""
        texts = pc.fill_null(texts.cast(pa.string()), "")
        out: list[bytes] = [b""] * len(texts)
        odd = pc.or_(pc.match_substring_regex(texts, OTHER_BLANKS), pc.equal(texts, "")).to_numpy(zero_copy_only=False)
        if not self.by_words:
            odd[:] = True
        for row in np.flatnonzero(odd):
            out[row] = self._plain(texts[row].as_py())
        rows = np.flatnonzero(~odd)
        if not len(rows):
            return out
        marked = pc.replace_substring(texts.take(pa.array(rows)), "\n", " \n")
        lists = pc.split_pattern(pc.binary_join_element_wise(pa.scalar("\n"), marked, pa.scalar("")), " ")
        ends = lists.offsets.to_numpy()
        coded = lists.flatten().dictionary_encode()
        del marked, lists
        words, places = coded.dictionary.to_pylist(), coded.indices.to_numpy()
        known = self.known
        learned = self._learn([w for w in words if w not in known])
        ids = [known[w] if w in known else learned[w] for w in words]
        self._remember(learned)
        del learned, words
        size = self.dtype.itemsize
        lengths = np.fromiter(map(len, ids), np.int64, len(ids)) // size
        starts = np.cumsum(lengths) - lengths
        flat = np.frombuffer(b"".join(ids), self.dtype)
        skip = len(self.line_break) // size
        for a in range(0, len(rows), TEXTS):
            some = rows[a : a + TEXTS]
            bounds = ends[a : a + len(some) + 1] - ends[0]
            of = places[bounds[0] : bounds[-1]]
            n = lengths[of]
            after = np.cumsum(n)
            gathered = flat[np.repeat(starts[of] - (after - n), n) + np.arange(after[-1])]
            cuts = np.concatenate([[0], after])[bounds - bounds[0]]
            for row, x, y in zip(some, cuts, cuts[1:]):
                out[row] = gathered[x + skip : y].tobytes()
        return out


def in_parts(batch: pa.RecordBatch, column: str = "text", most: int = MAX_BYTES) -> Iterator[pa.RecordBatch]:
    """A batch in parts of about `most` bytes of text; a longer text is a part by itself."""
    sizes = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False))
    start = 0
    while start < batch.num_rows:
        used = sizes[start - 1] if start else 0
        end = max(start + 1, int(np.searchsorted(sizes, used + most, "right")))
        yield batch.slice(start, end - start)
        start = end


def worker_encoder(data: str, width: int) -> Encoder:
    """The encoder of this worker process, kept for its later tasks."""
    kept = sys.modules.setdefault("_token_encoders", types.ModuleType("_token_encoders")).__dict__
    key = f"{width}:{hash(data)}"
    if key not in kept:
        kept[key] = Encoder(data, width)
    return kept[key]


def load_tokenizer(path: str) -> str:
    """The tokenizer file's text, some megabytes at most, to be sent to the workers."""
    with open(path, encoding="utf-8") as file:
        return file.read()


def width_for(data: str) -> int:
    """Bytes per id: two if all ids fit."""
    from tokenizers import Tokenizer

    return 2 if Tokenizer.from_str(data).get_vocab_size() <= 1 << 16 else 4
