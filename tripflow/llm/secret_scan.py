"""Secret scan: three patterns, and a linear-chain conditional random field for what they miss.

The field tags the tokens of a stretch (text without blanks) as secret begin,
inside or outside. A blank ends the chain, as no secret holds one, so stretches are
decoded one by one, by Viterbi, with features that look beyond them: the shape
of the token and its neighbours, the words before it, the marks around it, and how
much of the file looks like code. Stretches of under `SHORTEST` characters, or in which no
letter meets a digit, no small letter a capital and no run of letters and digits
is long, are outside by definition and aren't looked at.

Nobody has labelled secrets, so the field learns from a bounded sample of documents,
`TRAIN_DOCS`, and at most `TRAIN_STRETCHES` stretches of each. Matches of the patterns
are positive there, and generated secrets and look-alikes (versions, paths,
hashes of a few characters, identifiers, dates) are planted between the words of each sampled
text. All texts are scanned, and read whole.

Defined results: a null or empty text has no spans; an empty table gives an
empty table; long texts are read whole, a stretch of any length is decoded as one chain; repeated
rows get the same spans; equal spans of two kinds are both kept, ordered by kind, but a
span of the field inside one of a pattern is left out; null ids are scanned like others;
further columns are kept in `scan`, but those named like a result give way to it.
"""

from __future__ import annotations

import functools
import random
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripflow.session import materialise

# Fixed patterns: kind, pattern, group whose length counts, and its least length.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
# A match is a whole run, so its least length can be part of the pattern.
HEX = re.compile(r"[0-9a-f]{16,}")
ASSIGN_CHARS, ACCESS_CHARS = 12, 18
KINDS = ("assign", "access", "hex", "crf")
HINTS = ("pass", "secret", "token", "api")

Span = tuple[int, int, str]

# The bounded sample that the field learns from.
TRAIN_DOCS = 2_000
TRAIN_STRETCHES = 12
PLANTED = 6
MOST_ROUNDS = 20
TRAIN_CHARS = 100_000

# The field.
OUTSIDE, BEGIN, INSIDE = 0, 1, 2
SLOTS = 1 << 16
# Features of a token; a token with fewer has the slot behind the last one, whose weights stay zero.
SHAPE_FEATURES = 9
EPOCHS, BATCH, RATE, DECAY = 12, 256, 0.2, 1e-6
SHORTEST = 8
# Tokens of a training stretch; longer ones are cut, in training only.
TRAIN_TOKENS = 64

STRETCH = re.compile(r"\S{8,}")
CANDIDATE = re.compile(r"[A-Za-z][0-9]|[0-9][A-Za-z]|[a-z][A-Z]|[A-Za-z0-9_+/-]{24}")
TOKEN = re.compile(r"[^\W_]+|[\W_]")
WORD = re.compile(r"[^\W\d_]{2,}")


def base_spans(text: str) -> list[Span]:
    """The matches of the patterns, leftmost and non-overlapping per kind, as (start, end, kind)."""
    out: list[Span] = []
    low = text.lower()
    if any(h in low for h in HINTS):
        out += [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if len(m.group(2)) >= ASSIGN_CHARS]
    if "AKIA" in text:
        out += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text) if m.end() - m.start() >= ACCESS_CHARS]
    out += [(m.start(), m.end(), "hex") for m in HEX.finditer(text)]
    return out


def in_order(spans: list[Span]) -> str:
    """kind:start:end, by start, then kind as listed."""
    return ",".join(f"{k}:{a}:{b}" for a, b, k in sorted(spans, key=lambda s: (s[0], KINDS.index(s[2]), s[1])))


def _bucket(value: float, bounds: tuple[float, ...]) -> int:
    return sum(value >= b for b in bounds)


@functools.lru_cache(100_000)
def shape(token: str) -> tuple[str, str, tuple[str, ...]]:
    """Class of a token, class with length, and the features of its shape."""
    n = len(token)
    if n == 1 and not token.isalnum():
        return token, token, (f"p={token}",)
    digits = sum(c.isdigit() for c in token)
    upper = sum(c.isupper() for c in token)
    if digits == n:
        kind = "digits"
    elif digits:
        kind = "hex" if all(c in "0123456789abcdef" for c in token) else "MIXED" if upper == n - digits else "mixed" if not upper else "Mixed"
    elif upper == 0:
        kind = "lower"
    elif upper == n:
        kind = "UPPER"
    else:
        kind = "Capital" if upper == 1 and token[0].isupper() else "Camel"
    long = _bucket(n, (2, 3, 5, 8, 12, 16, 20, 28, 36, 48, 64))
    classes = ["d" if c.isdigit() else "u" if c.isupper() else "l" for c in token]
    turns = _bucket(sum(a != b for a, b in zip(classes, classes[1:])) / n, (0.06, 0.15, 0.3, 0.45))
    letters = n - digits
    vowels = _bucket(sum(c in "aeiouAEIOU" for c in token) / letters, (0.1, 0.22, 0.32, 0.5)) if letters > 3 else 9
    unlike = _bucket(len(set(token)) / n, (0.25, 0.4, 0.55, 0.75))
    at = f"{kind}{long}"
    return kind, at, (
        f"k={kind}", f"s={at}", f"t={turns}", f"kt={at}.{turns}", f"v={vowels}.{kind}", f"kv={at}.{vowels}", f"u={unlike}.{long}",
        f"g={token[:4]}", f"d={_bucket(digits / n, (0.01, 0.1, 0.25, 0.5, 0.9))}.{at}",
    )


def file_features(text: str) -> str:
    """How much of a file looks like code."""
    lines = text.count("\n") + 1
    marks = sum(text.count(c) for c in "={};")
    return f"{_bucket(marks / lines, (0.02, 0.2, 0.6, 1.5))}{_bucket(len(text) / lines, (20, 60, 200))}"


def stretch_features(text: str, start: int, tokens: list[str], file: str) -> list[list[int]]:
    """Slots of weights per token."""
    line = text[max(0, start - 60) : start].rpartition("\n")[2]
    words = [w.lower() for w in WORD.findall(line)][-2:]
    marks = re.sub(r"[\w\s]", "", line[-6:])
    shapes = [shape(t) for t in tokens]
    edge = ("^", "^", ())
    out = []
    for i, (kind, at, own) in enumerate(shapes):
        left, right = (shapes[i - 1] if i else edge), (shapes[i + 1] if i + 1 < len(shapes) else edge)
        far = shapes[i - 2][0] if i > 1 else "^"
        w1, w2 = (words[-1] if words else "^"), (words[-2] if len(words) > 1 else "^")
        names = [
            *own, f"l={left[0]}", f"r={right[0]}", f"ls={left[1]}", f"rs={right[1]}", f"lr={left[0]} {right[0]}", f"lk={far} {left[0]} {kind}",
            f"w={w1}", f"w2={w2}", f"wk={w1}.{kind}", f"wl={w1}.{left[0]}", f"m={marks[-2:]}.{kind}", f"f={file}.{at}", f"i={min(i, 3)}.{kind}",
        ]
        out.append([zlib.crc32(x.encode()) % SLOTS for x in names] + [SLOTS] * (SHAPE_FEATURES - len(own)))
        if kind != "digits" and len(tokens[i]) > 1 and WORD.fullmatch(tokens[i]):
            words = [*words, tokens[i].lower()][-2:]
            marks = ""
        elif len(tokens[i]) == 1:
            marks += tokens[i]
    return out


def viterbi(scores: list[list[float]], steps: list[list[float]]) -> list[int]:
    """The best tags of a chain; INSIDE follows BEGIN or INSIDE only."""
    o, b, i = scores[0][OUTSIDE], scores[0][BEGIN], float("-inf")
    back = []
    (oo, ob, _), (bo, bb, bi), (io, ib, ii) = steps
    for so, sb, si in scores[1:]:
        to_o = max((o + oo, OUTSIDE), (b + bo, BEGIN), (i + io, INSIDE))
        to_b = max((o + ob, OUTSIDE), (b + bb, BEGIN), (i + ib, INSIDE))
        to_i = max((b + bi, BEGIN), (i + ii, INSIDE))
        back.append((to_o[1], to_b[1], to_i[1]))
        o, b, i = to_o[0] + so, to_b[0] + sb, to_i[0] + si
    tag = max((o, OUTSIDE), (b, BEGIN), (i, INSIDE))[1]
    tags = [tag]
    for came in reversed(back):
        tag = came[tag]
        tags.append(tag)
    return tags[::-1]


@dataclass
class Field:
    """Weights per feature slot and tag, and per pair of tags."""

    weights: np.ndarray
    steps: np.ndarray

    @staticmethod
    def empty() -> Field:
        return Field(np.zeros((SLOTS + 1, 3)), np.zeros((3, 3)))

    def spans(self, text: str) -> list[Span]:
        """The spans that the field finds."""
        file, out, steps = None, [], None
        if not self.weights.any():  # nothing was learned
            return out
        for m in STRETCH.finditer(text):
            body = m.group()
            if not CANDIDATE.search(body):
                continue
            if file is None:
                file, steps = file_features(text), self.steps.tolist()
            tokens = TOKEN.findall(body)
            scores = self.weights[np.array(stretch_features(text, m.start(), tokens, file))].sum(1).tolist()
            at, open_at = m.start(), None
            for token, tag in zip(tokens, viterbi(scores, steps)):
                if tag != INSIDE and open_at is not None:
                    out.append((open_at, at, "crf"))
                    open_at = None
                if tag == BEGIN:
                    open_at = at
                at += len(token)
            if open_at is not None:
                out.append((open_at, at, "crf"))
        return [s for s in out if s[1] - s[0] >= SHORTEST]


def all_spans(text: str, field: Field) -> tuple[list[Span], list[Span]]:
    """The spans of the patterns, and all spans."""
    base = base_spans(text)
    more = [s for s in field.spans(text) if not any(a <= s[0] and s[1] <= b for a, b, _ in base)]
    return base, base + more


# What is planted into sampled texts, to learn from.
LETTERS, DIGITS = "abcdefghijklmnopqrstuvwxyz", "0123456789"
ALNUM = LETTERS + LETTERS.upper() + DIGITS
KEYWORDS = (
    "password passwd pwd pass passphrase secret client_secret secret_key secretKey token access_token auth_token refreshToken "
    "api_key apikey apiKey private_key access_key credential credentials auth key signing_key db_password DB_PASS API_TOKEN"
).split()
PLAIN_NAMES = (
    "id version commit path file name user host port date build release width color page ref ticket module size time url token_count "
    "password_length key_name public_id checksum etag"
).split()


def _any(rng: random.Random, chars: str, low: int, high: int) -> str:
    return "".join(rng.choices(chars, k=rng.randint(low, high)))


def _secret(rng: random.Random) -> str:
    """Random characters, as in keys and passwords."""
    form = rng.randrange(8)
    if form == 0:
        return _any(rng, DIGITS + "abcdef", 24, 48)
    if form == 1:
        return _any(rng, ALNUM + "+/", 22, 64) + rng.choice(("", "=", "=="))
    if form == 2:
        return _any(rng, ALNUM + "!@#$%^&*", 9, 18) + rng.choice(DIGITS)
    if form == 3:
        return _any(rng, LETTERS, 2, 5) + rng.choice("_-") + _any(rng, ALNUM, 20, 40)
    if form == 4:
        return _any(rng, LETTERS, 2, 4) + "_" + _any(rng, LETTERS, 4, 4) + "_" + _any(rng, ALNUM, 20, 32)
    if form == 5:
        return ".".join(("eyJ" + _any(rng, ALNUM, 12, 30), "eyJ" + _any(rng, ALNUM + "_-", 20, 60), _any(rng, ALNUM + "_-", 24, 43)))
    if form == 6:
        return _any(rng, LETTERS.upper(), 4, 4) + _any(rng, LETTERS.upper() + DIGITS, 14, 20)
    return _any(rng, LETTERS, 3, 4) + "-" + _any(rng, DIGITS, 9, 12) + "-" + _any(rng, ALNUM, 16, 28)


def _word(rng: random.Random) -> str:
    return "".join(rng.choice("bcdfglmnprstv") + rng.choice("aeiou") for _ in range(rng.randint(2, 4)))


def plant_secret(rng: random.Random) -> tuple[str, int, int]:
    """A piece of text, and the place of the secret in it."""
    value, form = _secret(rng), rng.randrange(6)
    if form < 3 or len(value) < 20 and form == 5:
        quote = rng.choice(("", '"', "'"))
        head = rng.choice(KEYWORDS) + rng.choice(("=", ": ", " = ", ":", '": ', " is ")) + quote
        tail = quote + rng.choice(("", ",", ";"))
    elif form == 3:
        head, tail = rng.choice(("Authorization: Bearer ", "bearer ", "x-api-key: ", "-H 'Authorization: token ")), rng.choice(("", "'", '"'))
    elif form == 4:
        value = re.sub(r"[@/:#]", "x", value)
        head, tail = f"{rng.choice(('postgres', 'mysql', 'amqp', 'https', 'redis'))}://{_word(rng)}:", f"@{_word(rng)}.{_word(rng)}:{rng.randint(80, 9999)}/{_word(rng)}"
    else:
        head, tail = rng.choice(("", "(", "'", '"')), rng.choice(("", ")", "'", '"', "."))
    return head + value + tail, len(head), len(head) + len(value)


def plant_other(rng: random.Random) -> str:
    """A piece of text that looks like a secret to a careless eye."""
    w = functools.partial(_word, rng)
    body = (
        lambda: f"{rng.randint(0, 20)}.{rng.randint(0, 20)}.{rng.randint(0, 99)}-{rng.choice(('beta', 'rc', 'alpha'))}{rng.randint(0, 9)}",
        lambda: f"20{rng.randint(10, 30)}-{rng.randint(10, 12)}-{rng.randint(10, 28)}T{rng.randint(10, 23)}:{rng.randint(10, 59)}:{rng.randint(10, 59)}Z",
        lambda: f"https://{w()}.{w()}/{w()}/{w()}-{rng.randint(1, 99999)}.html?page={rng.randint(1, 50)}",
        lambda: f"/{w()}/{w()}{rng.randint(1, 9)}/{w()}_{rng.randint(1, 2000)}.{rng.choice(('py', 'txt', 'json', 'png'))}",
        lambda: f"{w()}{w().title()}{w().title()}{rng.randint(1, 9)}",
        lambda: f"{w()}_{w()}_{w()}_{rng.randint(1, 999)}",
        lambda: f"{w()}.{w()}{rng.randint(1, 99)}@{w()}.com",
        lambda: "-".join(_any(rng, DIGITS + "abcdef", k, k) for k in (8, 4, 4, 4, 12)),
        lambda: _any(rng, DIGITS + "abcdef", 7, 12),
        lambda: ".".join(str(rng.randint(0, 255)) for _ in range(4)) + f":{rng.randint(80, 9999)}",
        lambda: f"+{rng.randint(1, 99)}-{rng.randint(100, 999)}-{rng.randint(1000000, 9999999)}",
        lambda: f"{w().title()}{w().title()}({w()}{rng.randint(0, 9)},{w()})",
        lambda: _any(rng, DIGITS, 8, 16),
        lambda: f"{rng.randint(10, 4000)}x{rng.randint(10, 4000)}px",
        lambda: f"{w()}{w()}{w()}{w()}{w()}{w()}{w()}{w()}"[: rng.randint(24, 40)],
        lambda: f"{w().upper()}-{rng.randint(1, 99999)}",
    )
    form = rng.randrange(len(body) + 3)
    if form >= len(body):
        name = rng.choice(KEYWORDS)
        return name + rng.choice(("=", ": ", " = ")) + rng.choice((w(), "required", f"${{{w().upper()}}}", "null", f"get_{w()}()", "********", f"<{w()}>", f"os.{w()}[{w()}]"))
    head = rng.choice((rng.choice(PLAIN_NAMES) + rng.choice(("=", ": ", " = ", " ")), "", "", "("))
    return head + body[form]()


def training_text(text: str, seed: int, planted: int = PLANTED) -> tuple[str, list[tuple[int, int]]]:
    """A sampled text with pieces planted between its words, and the places of all secrets in it."""
    rng = random.Random(seed)
    gaps = sorted(rng.sample(places, min(planted, len(places))) if (places := [m.start() for m in re.finditer(r"\s", text)]) else [0])
    out, at, gold = [], 0, []
    size = 0
    for gap in gaps:
        out.append(text[at:gap] + " ")
        size += gap - at + 1
        at = gap
        if rng.random() < 0.5:
            piece, a, b = plant_secret(rng)
            gold.append((size + a, size + b))
        else:
            piece = plant_other(rng)
        out.append(piece)
        size += len(piece)
    whole = "".join(out) + text[at:]
    for m in ASSIGN.finditer(whole):
        if len(m.group(2)) >= ASSIGN_CHARS and not any(a < m.end(2) and m.start(2) < b for a, b in gold):
            gold.append(m.span(2))
    gold += [m.span() for m in ACCESS.finditer(whole) if m.end() - m.start() >= ACCESS_CHARS and not any(a < m.end() and m.start() < b for a, b in gold)]
    return whole, gold


def training_rows(text: str, gold: list[tuple[int, int]], most: int = TRAIN_STRETCHES) -> Iterator[tuple[list[list[int]], list[int]]]:
    """Features and tags of the stretches of a training text; those with secrets first, up to `most`."""
    found, file = [], file_features(text)
    for m in STRETCH.finditer(text):
        if CANDIDATE.search(m.group()):
            inside = any(a < m.end() and m.start() < b for a, b in gold)
            found.append((not inside, zlib.crc32(m.group().encode(errors="replace")), m))
    for _, _, m in sorted(found, key=lambda x: x[:2])[:most]:
        tokens, tags, at = TOKEN.findall(m.group()), [], m.start()
        whole_digits = HEX.fullmatch(m.group()) and m.group().isdigit()
        if whole_digits:  # long numbers match a pattern but teach nothing
            continue
        for token in tokens:
            of = next((g for g in gold if g[0] <= at and at + len(token) <= g[1]), None)
            tags.append(OUTSIDE if of is None else BEGIN if at == of[0] or not tags or tags[-1] == OUTSIDE else INSIDE)
            at += len(token)
        yield stretch_features(text, m.start(), tokens, file)[:TRAIN_TOKENS], tags[:TRAIN_TOKENS]


def log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis, keepdims=True)
    return np.log(np.exp(x - top).sum(axis)) + top.squeeze(axis)


FORBIDDEN = np.array([[0.0, 0.0, -1e4], [0.0, 0.0, 0.0], [0.0, 0.0, 0.0]])


def slopes(scores: np.ndarray, steps: np.ndarray, tags: np.ndarray, known: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
    """Log likelihood of padded chains, and its slopes by score and by step (forward-backward)."""
    n, size, _ = scores.shape
    steps = steps + FORBIDDEN
    first = np.where(np.arange(3) == INSIDE, -1e4, 0.0)
    ahead = np.zeros_like(scores)
    ahead[:, 0] = scores[:, 0] + first
    for k in range(1, size):
        move = log_sum(ahead[:, k - 1, :, None] + steps, 1) + scores[:, k]
        ahead[:, k] = np.where(known[:, k, None], move, ahead[:, k - 1])
    total = log_sum(ahead[:, -1], 1)
    behind = np.zeros_like(scores)
    pairs = np.zeros((3, 3))
    by_score = np.zeros_like(scores)
    for k in range(size - 1, -1, -1):
        by_score[:, k] = np.exp(np.where(known[:, k, None], ahead[:, k] + behind[:, k] - total[:, None], -1e4))
        if k:
            on = known[:, k, None]
            after = scores[:, k] + behind[:, k]
            both = ahead[:, k - 1, :, None] + steps + after[:, None, :] - total[:, None, None]
            pairs += (np.exp(both) * on[:, :, None]).sum(0)
            behind[:, k - 1] = np.where(on, log_sum(steps + after[:, None, :], 2), behind[:, k])
    rows = np.arange(n)
    gold, gold_pairs = np.zeros_like(scores), np.zeros((3, 3))
    for k in range(size):
        gold[rows, k, tags[:, k]] = known[:, k]
        if k:
            np.add.at(gold_pairs, (tags[:, k - 1], tags[:, k]), known[:, k])
    likely = float((gold * scores).sum() + (gold_pairs * steps).sum() - total.sum())
    return likely, gold - by_score, gold_pairs - pairs


def fit(rows: list[tuple[list[list[int]], list[int]]], epochs: int = EPOCHS) -> Field:
    """A field fitted to chains of (feature slots, tags) by steps of adaptive size."""
    field = Field.empty()
    if not rows:
        return field
    rng = np.random.default_rng(11)
    spent, spent_steps = np.full((SLOTS + 1, 3), 1e-6), np.full((3, 3), 1e-6)
    order = sorted(range(len(rows)), key=lambda i: len(rows[i][1]))
    batches = [order[i : i + BATCH] for i in range(0, len(order), BATCH)]
    for _ in range(epochs):
        for at in rng.permutation(len(batches)):
            chosen = [rows[i] for i in batches[at]]
            size = max(len(t) for _, t in chosen)
            slots = np.full((len(chosen), size, len(chosen[0][0][0])), SLOTS)
            tags, known = np.zeros((len(chosen), size), np.int64), np.zeros((len(chosen), size), bool)
            for i, (features, own) in enumerate(chosen):
                slots[i, : len(own)], tags[i, : len(own)], known[i, : len(own)] = features, own, True
            _, by_score, by_step = slopes(field.weights[slots].sum(2), field.steps, tags, known)
            slope = np.zeros_like(field.weights)
            np.add.at(slope, slots, by_score[:, :, None, :])
            slope[SLOTS] = 0
            slope -= DECAY * len(chosen) * field.weights
            spent += slope**2
            spent_steps += by_step**2
            field.weights += RATE * slope / np.sqrt(spent)
            field.steps += RATE * by_step / np.sqrt(spent_steps)
    return field


def train(docs: DataFrame, most_docs: int = TRAIN_DOCS) -> Field:
    """A field fitted to a bounded sample of the documents, those whose ids have the lowest hashes."""
    known = docs.select(F.col("doc_id").cast("string").alias("doc_id"), "text").filter("doc_id IS NOT NULL AND text IS NOT NULL")
    ids = known.select("doc_id").distinct().orderBy(F.xxhash64(F.lit(11), "doc_id"), "doc_id").limit(most_docs)
    chosen = materialise(ids)  # at most most_docs rows
    sample = known.join(F.broadcast(chosen), "doc_id").groupBy("doc_id").agg(F.min("text").alias("text"))
    # A small corpus is gone through several times, with other pieces planted.
    rounds = min(MOST_ROUNDS, -(-most_docs // max(1, chosen.count())))
    sample = sample.withColumn("round", F.explode(F.sequence(F.lit(1), F.lit(rounds))))

    numbers = pa.list_(pa.int32())
    numbers_in_lists = pa.list_(numbers)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, text, turn in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text", "round"))):
                whole, gold = training_text(text[:TRAIN_CHARS], zlib.crc32(f"{turn}:{i}".encode()))
                slots, tags = zip(*rows) if (rows := list(training_rows(whole, gold))) else ((), ())
                columns = [pa.array([i] * len(rows), pa.string()), pa.array(slots, numbers_in_lists), pa.array(tags, numbers)]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "slots", "tags"])

    rows = sample.mapInArrow(run, "doc_id string, slots array<array<int>>, tags array<int>").collect()  # 2 * most_docs * TRAIN_STRETCHES at most
    return fit([(r["slots"], r["tags"]) for r in sorted(rows)])


FIELDS = ("n_assign", "n_access", "n_hex", "n_crf")


def scan(docs: DataFrame, field: Field) -> DataFrame:
    """Every document with its spans (an array of kind, start, end in code points) and their numbers per kind."""
    docs = docs.select(*[f"`{c}`" for c in docs.columns if c not in ("spans", *FIELDS)])
    plain = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])  # names with a dot aren't found by mapInArrow
    at = docs.columns.index("text")
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
    more = [T.StructField(c, T.LongType()) for c in FIELDS]
    span = T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()), T.StructField("end", T.LongType())])
    schema = T.StructType([*docs.schema.fields, *more, T.StructField("spans", T.ArrayType(span))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, counts = [], {k: [] for k in KINDS}
            for text in batch.column(at):
                spans = all_spans(text.as_py() or "", field)[1]
                spans.sort(key=lambda s: (s[0], KINDS.index(s[2]), s[1]))
                found.append([{"kind": k, "start": a, "end": b} for a, b, k in spans])
                for k in KINDS:
                    counts[k].append(sum(s[2] == k for s in spans))
            columns = [*batch.columns, *(pa.array(counts[k], pa.int64()) for k in KINDS), pa.array(found, kind)]
            yield pa.RecordBatch.from_arrays(columns, names=[f.name for f in schema.fields])

    return plain.mapInArrow(run, schema)
