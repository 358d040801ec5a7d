"""Token alignment against a plain version that walks every text token by token."""

import collections
import hashlib

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tripflow.llm import alignment, queries

FIRST, SECOND = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def byte_of():
    seen = [*range(33, 127), *range(161, 173), *range(174, 256)]
    free = iter(range(256, 512))
    return {(chr(b) if b in seen else chr(next(free))): b for b in range(256)}


class Plain:
    def __init__(self):
        self.a, self.b = Tokenizer.from_file(FIRST), sentencepiece.SentencePieceProcessor(model_file=SECOND)
        self.a.encode_special_tokens = True
        self.letters = byte_of()

    def bytes_of(self, which, i):
        if which == "a":
            return bytes(self.letters[c] for c in self.a.id_to_token(i))
        piece = self.b.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if self.b.is_byte(i) else piece.replace("▁", " ").encode()

    def groups(self, text):
        told = (" " + (text or "")).encode()
        a, b = self.a.encode(" " + (text or ""), add_special_tokens=False).ids, self.b.encode(text or "")
        coded = [[self.bytes_of(w, i) for i in ids] for w, ids in (("a", a), ("b", b))]
        if not text or any(b"".join(c) != told for c in coded):
            return 0, 0, []
        out, own, at = [], ([], []), [0, 0]
        i = j = 0
        while i < len(a) or j < len(b):
            if j == len(b) or i < len(a) and at[0] <= at[1]:
                own[0].append(a[i])
                at[0] += len(coded[0][i])
                i += 1
            else:
                own[1].append(b[j])
                at[1] += len(coded[1][j])
                j += 1
            if at[0] == at[1]:
                out.append(own)
                own = ([], [])
        return len(a), len(b), out


def plain_rows(texts):
    plain, found, counts = Plain(), [], collections.Counter()
    for text in texts:
        n_a, n_b, groups = plain.groups(text)
        links = collections.Counter((x, y) for g in groups for x in g[0] for y in g[1])
        counts.update(links.keys())
        found.append((n_a, n_b, groups, links))
    best = {}
    for (x, _), n in counts.items():
        best[x] = max(best.get(x, 0), n)
    out = []
    for n_a, n_b, groups, links in found:
        told = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        out.append((
            n_a, n_b, len(groups), sum(links.values()), sum(n for p, n in links.items() if counts[p] == best[p[0]]),
            sum(n * counts[p] for p, n in links.items()), hashlib.sha256(told.encode()).hexdigest() if groups else "",
        ))
    return out


ODD = [
    None, "", " ", "a", " two  blanks ", "\n", "tab\there", "line\nbreak and\r\nmore", "<|endoftext|> <s> </s> <unk> <0x0A> ▁ x", "<|endoftext|> <s> </s>",
    "naïve 日本語 \U0001f600\U0001f680 é ﬁ ①", "x" * 300, "ab" * 400, "=" * 77 + "    " * 9, "▁", "\x00 nul", "it's we'll 12345 3.14",
]


@pytest.mark.parametrize("piece", [7, 64, alignment.PIECE])
def test_alignment_of_odd_texts(make_docs, odd_docs, piece):
    rng = np.random.default_rng(5)
    words = [f"{a}{b}" for a in ("anti", "Over", "über", "x", "(") for b in ("lap", "ping,", "9", "")]
    texts = ODD + [" ".join(rng.choice(words, rng.integers(1, 90))) for _ in range(30)] + [ODD[7]] * 3
    texts += [r["text"] if len(r["text"] or "") < 5_000 else r["text"][:5_000] for r in odd_docs.collect()]
    got = alignment.align_and_count(make_docs(texts), alignment.Tokenizers.load(FIRST, SECOND, piece)).collect()
    assert [tuple(r)[1:] for r in sorted(got, key=lambda r: r["doc_id"])] == plain_rows(texts)


def test_alignment_of_the_table(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").orderBy("doc_id").collect()
    got = queries.QUERIES["op12_token_alignment"](spark, sf_dir).orderBy("doc_id").collect()
    assert [r["doc_id"] for r in got] == [r["doc_id"] for r in docs]
    assert [tuple(r)[1:] for r in got] == plain_rows([r["text"] for r in docs])


def test_groups_as_text_and_rare_pairs(make_docs, monkeypatch):
    monkeypatch.setattr(alignment, "BIG_GROUP", 1)
    texts = ["one two", "one two three", "one", "tokenization"]
    both = alignment.Tokenizers.load(FIRST, SECOND)
    docs = make_docs(texts).withColumns({c: F.lit("own") for c in ("row", "pair", "docs", "groups", "a.b", "piece")})
    aligned = alignment.align(docs, both, whole=True)
    told = {r["doc_id"]: bytes(r["groups"]).decode() for r in aligned.collect()}
    for i, text in enumerate(texts):
        groups = Plain().groups(text)[2]
        assert told[i] == ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
    counts = alignment.pair_counts(aligned, len(both.lengths_b))
    for most in (0, 2, 1_000):
        sums = {r["row"]: (r["n_best"], r["count_sum"]) for r in alignment.link_sums(aligned, counts, most).collect()}
        rows = {r["row"]: r["doc_id"] for r in aligned.collect()}
        assert {rows[k]: v for k, v in sums.items()} == {i: (r[4], r[5]) for i, r in enumerate(plain_rows(texts))}


def test_diagonals_divide_the_merge_evenly():
    rng = np.random.default_rng(2)
    for _ in range(50):
        a, b = (np.unique(rng.integers(1, 200, 60)) for _ in range(2))
        merged = sorted([*((e, 0) for e in a), *((e, 1) for e in b)])
        for d in range(len(merged) + 1):
            i, j = alignment.diagonal(a, b, d)
            assert i + j in (d, d + 1) and sorted([*((e, 0) for e in a[:i]), *((e, 1) for e in b[:j])]) == merged[: i + j]
            assert not (0 < i and j < len(b) and a[i - 1] == b[j])


def test_tokens_equal_the_libraries(odd_docs):
    plain = Plain()
    texts = [t for t in ODD if t] + [r["text"] for r in odd_docs.collect() if r["text"]] + ["ελληνικά Кириллица €5 … “q”", "\u0300a \u2028 b", "I'll we'RE'"]
    first, second = alignment.FirstTokens(alignment.load_tokenizer(FIRST)), alignment.SecondTokens(open(SECOND, "rb").read())
    assert first.ranked and second.by_words
    for text, a, b in zip(texts, first.encode(texts), second.encode(texts)):
        assert a.tolist() == plain.a.encode(" " + text, add_special_tokens=False).ids == plain.a.encode(" " + text).ids
        assert b is None or b.tolist() == plain.b.encode(text)
