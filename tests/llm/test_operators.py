"""Each operator against a plain version, on small and odd inputs."""

import collections
import hashlib
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from oracle import compare, connect
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import __spark_entry__ as contract
import corpus_pipeline
from tripflow.llm import curriculum, licences, line_dedup, ngram_join, packing, quality, queries, records, sharding, tokens, topk, toxicity
from tripflow.llm.cuckoo import CuckooFilter

BLANKS = " \t\n\x0b\f\r"
PATH = public_tokenizers.path("byte_bpe_50k.json")


def lower(text):
    return text.encode().lower().decode()


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_matches_sql(spark, sf_dir, name):
    assert compare(connect(sf_dir), queries.QUERIES[name](spark, sf_dir), queries.ORACLES[name]) is None


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_empty_tables(spark, tmp_path, sf_dir, name):
    for t in ("documents", "embeddings", "labels"):
        spark.read.parquet(f"{sf_dir}/{t}.parquet").limit(0).write.parquet(f"{tmp_path}/{t}.parquet")
    assert queries.QUERIES[name](spark, str(tmp_path)).count() == 0


def test_cuckoo_filter_is_reversible():
    rng = np.random.default_rng(1)
    hi, lo = rng.integers(-(1 << 62), 1 << 62, (2, 3_000))
    made = CuckooFilter.for_keys(3_000)
    assert made.insert(hi[:1_000], lo[:1_000])
    before = made.contains(hi[:1_000], lo[:1_000])
    assert before.all() and made.insert(hi[1_000:], lo[1_000:]) and made.contains(hi, lo).all()
    made.delete(hi[1_000:], lo[1_000:])
    assert made.contains(hi[:1_000], lo[:1_000]).all() and made.contains(hi[1_000:], lo[1_000:]).mean() < 0.01


def test_line_index_forgets_deleted_documents(spark, make_docs):
    first = make_docs([f"common\nown {i}" for i in range(4)])
    second = make_docs([f"common \n  COMMON\nother {i % 2}" for i in range(6)])
    index = line_dedup.LineIndex(spark, min_docs=5, shards=3)
    a, b = index.keys(first), index.keys(second)
    index.insert(a)
    counts = sorted(map(tuple, index.counts.collect()))
    assert index.frequent().count() == 0
    index.insert(b)
    assert index.frequent().count() == 1 and index.probe(a).count() >= 4
    assert {r["kept_text"] for r in index.clean(second, b).collect()} == {"other 0", "other 1"}
    index.delete(b)
    assert sorted(map(tuple, index.counts.collect())) == counts and index.frequent().count() == 0
    assert index.probe(a).count() == 0
    with pytest.raises(Exception, match="not in the index"):
        index.delete(b)


def test_line_index_outlives_its_session(spark, make_docs, tmp_path, monkeypatch):
    monkeypatch.setattr(line_dedup, "SHARD_KEYS", 2)
    first = make_docs([f"common\nalso {i % 3}\nown {i}" for i in range(9)])
    second = make_docs([f"common\nnew {i % 4}" for i in range(12)])
    index = line_dedup.LineIndex(spark, min_docs=3, shards=1)
    a = index.keys(first)
    index.insert(a)
    assert index.shards == 2 and index.frequent().count() == 4
    index.save(f"{tmp_path}/index")
    other = line_dedup.LineIndex.open(spark.newSession(), f"{tmp_path}/index")
    assert (other.shards, other.min_docs, other.min_chars) == (2, 3, 1)
    b = other.keys(second)
    other.insert(b)
    assert other.shards == 4 and other.frequent().count() == 8
    assert {r["kept_text"] for r in other.clean(second, b).collect()} == {""}
    other.delete(a)  # keys dealt to fewer shards
    assert sorted(r["n"] for r in other.counts.collect()) == [3, 3, 3, 3, 12] and other.frequent().count() == 5
    assert other.probe(a).count() >= 9 and index.frequent().count() == 4


def test_line_dedup_of_odd_texts(odd_docs):
    got = {r["doc_id"]: r for r in line_dedup.dedup_lines(odd_docs, min_docs=2).collect()}
    assert got[0]["kept_text"] == "" and got[0]["n_lines"] == 1 and got[2]["n_dropped"] == 0
    assert got[5]["kept_text"] == "" and got[5]["n_dropped"] == 2 and got[9]["kept_text"] == "x\n\ny"


def test_top_k(spark):
    rows = [(i, [float(v) for v in np.random.default_rng(i % 40).normal(size=3)]) for i in range(300)]
    rows += [(300, None), (301, [1.0, None, 2.0]), (302, [float("nan"), 0.0, 0.0]), (303, [float("inf"), 0.0, 0.0]), (304, [1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("rank", F.lit("clash"))
    got = collections.defaultdict(list)
    for r in topk.top_k(df, F.col("vec_id") % 50 == 0).orderBy("query_id", "rank").collect():
        got[r["query_id"]].append((r["vec_id"], r["score"]))
    good = {i: np.floor(256 * np.array(v)).astype(int) for i, v in rows[:300]}
    for q in range(0, 300, 50):
        best = sorted(((-int(good[q] @ v), i) for i, v in good.items() if i != q))[:5]
        assert got[q] == [(i, -s) for s, i in best]
    assert set(got) == set(range(0, 300, 50))


def clustered(spark, clusters=24, rows=60, dim=6):
    rng = np.random.default_rng(7)
    centres = rng.normal(size=(clusters, dim)) * 4
    made = [(c * rows + i, (centres[c] + rng.normal(size=dim) * 0.05).tolist()) for c in range(clusters) for i in range(rows)]
    return spark.createDataFrame(made, "vec_id long, embedding array<double>"), made


@pytest.mark.parametrize("group", [1, 4])
def test_top_k_over_cells_of_space(spark, monkeypatch, group):
    monkeypatch.setattr(topk, "SHARD_ROWS", 40)
    monkeypatch.setattr(topk, "BLOCK_QUERIES", 8)
    monkeypatch.setattr(topk, "GROUP_SHARDS", group)
    df, made = clustered(spark)
    twins = spark.createDataFrame([(9_000 + i % 2, [5.0] * 6) for i in range(300)], df.schema)
    made = made + [(9_000 + i % 2, [5.0] * 6) for i in range(300)] + [(9_500, [1.0, 2.0])]
    df = df.unionByName(twins).unionByName(spark.createDataFrame([(9_500, [1.0, 2.0])], df.schema))
    got = collections.defaultdict(list)
    for r in topk.top_k(df, F.col("vec_id") % 50 == 0).orderBy("query_id", "rank").collect():
        got[r["query_id"]].append((r["vec_id"], r["score"]))
    good = [(i, np.floor(256 * np.array(v)).astype(int)) for i, v in made]
    for q in {i for i, _ in good if i % 50 == 0}:
        own = next(v for i, v in good if i == q)
        best = sorted((-int(own @ v), i) for i, v in good if i != q and len(v) == len(own))[:5]
        assert got[q] == [(i, -s) for s, i in best]


def test_trees_go_only_where_a_box_reaches(spark, monkeypatch):
    monkeypatch.setattr(topk, "SHARD_ROWS", 60)
    monkeypatch.setattr(topk, "BLOCK_QUERIES", 8)
    df, _ = clustered(spark)
    points = df.select("vec_id", topk.quantised(F.col("embedding")).alias("vector")).withColumn("dim", F.size("vector"))
    space = topk.split_space(points)
    trees = topk.plant(points, space)
    boxes = topk.cell_boxes(trees, space)
    assert trees.agg(F.sum("n")).first()[0] == 24 * 60 and len(boxes[6][0]) > 12
    queries = points.filter("vec_id % 5 = 0").withColumnRenamed("vec_id", "query_id")
    queries = topk.in_blocks(topk.best_cell(queries, boxes))
    best = {r["query_id"]: r["score"] for r in topk.top_k(df, F.col("vec_id") % 5 == 0).filter("rank = 5").collect()}
    floors = spark.createDataFrame(list(best.items()), "query_id long, floor long")
    asked = topk.asked_groups(topk.cells_in_reach(queries.join(floors, "query_id"), boxes), trees)
    block = ["dim", "home", "part"]
    shipped = asked.select(*block, "cell", "group").distinct().count()
    everything = queries.select(*block).distinct().count() * trees.select("cell", "group").distinct().count()
    assert shipped < everything / 3


def test_homes_share_blocks_of_queries(spark, monkeypatch):
    """Trees are copied once per block, so a block may not end with its cell: 24 cells of 12 queries are 3 blocks of 96."""
    monkeypatch.setattr(topk, "BLOCK_QUERIES", 96)
    rows = [(q, 2, [q, 1], q % 24) for q in range(288)] + [(999, 3, [1, 2, 3], 0)]
    placed = topk.in_blocks(spark.createDataFrame(rows, "query_id long, dim int, vector array<long>, home int")).collect()
    blocks = collections.Counter((r["dim"], r["part"]) for r in placed)
    assert len(placed) == 289 and set(blocks) == {(2, 0), (2, 1), (2, 2), (3, 0)} and max(blocks.values()) < 130
    assert all(len({r["part"] for r in placed if r["dim"] == 2 and r["home"] == h}) == 1 for h in (0, 23))
    monkeypatch.setattr(topk, "BLOCK_NUMBERS", 48)  # long vectors: fewer queries
    longer = spark.createDataFrame(rows, "query_id long, dim int, vector array<long>, home int")
    assert topk.in_blocks(longer).select("dim", "part").distinct().count() == 13


def test_queries_per_cell_are_not_broadcast(spark):
    """The table of queries is small on disk, but not once a query stands for each cell in its reach."""
    asked = topk.materialise(spark.createDataFrame([(1, 2, [1, 2], 0, 0, [0, 1], 5)], "query_id long, dim int, vector array<long>, home int, part int, cells array<int>, floor long"))
    trees = spark.createDataFrame([(2, 0, 0), (2, 1, 0), (2, 1, 1)], "dim int, cell int, group int")  # of unknown size
    later = topk.asked_groups(asked, trees)
    assert sorted((r["cell"], r["group"]) for r in later.collect()) == [(1, 0), (1, 1)]
    plan = later._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "BuildLeft" not in plan


@pytest.mark.parametrize(("top", "kind"), [(30, np.float32), (1 << 20, np.float64), (1 << 28, np.int64)])
def test_tree_takes_the_best_of_a_block(top, kind):
    rng = np.random.default_rng(top)
    vectors, queries = rng.integers(-top, top, (700, 5)), rng.integers(-top, top, (90, 5))
    vectors[300:600] = vectors[299]  # ties
    ids, own, floors = rng.permutation(700) - 350, rng.integers(-350, 350, 90), np.full(90, topk.NONE)
    plain = [sorted((-int(s), int(i)) for s, i in zip(vectors @ q, ids) if i != o)[:4] for q, o in zip(queries, own)]
    floors[::2] = [-best[3][0] for best in plain[::2]]
    assert topk.exact_kind(queries, vectors, vectors) == kind
    best = topk.Best(own, floors, 4)
    for part in (slice(0, 350), slice(350, 700)):
        topk.Tree.build(ids[part], vectors[part], leaf=16).search(queries, best)
    assert [[(-s, i) for s, i in zip(*x)] for x in zip(best.scores.tolist(), best.ids.tolist())] == plain


def test_top_k_of_one_hot_row(spark, monkeypatch):
    monkeypatch.setattr(topk, "SHARD_ROWS", 10)
    rows = [(1, [1.0])] * 40 + [(2, [1.0])] * 3 + [(3, [0.5])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    points = df.select("vec_id", topk.quantised(F.col("embedding")).alias("vector")).withColumn("dim", F.size("vector"))
    assert collections.Counter(r["vec_id"] for r in topk.few_copies(points, 5).collect()) == {1: 5, 2: 3, 3: 1}
    got = topk.top_k(df, F.col("vec_id") != 2, k=5).orderBy("query_id", "rank").collect()
    assert [(r["query_id"], r["vec_id"]) for r in got] == [(1, 2)] * 3 + [(1, 3)] + [(3, 1)] * 5


def test_encoder_equals_the_library(odd_docs):
    texts = ["a b\nc", "x y", " a", "a  b\n", "don't 12 3.5, a² naïve… «q» <|endoftext|> x", "é x.. y?!\n'tis", "", "tab\there", "a b"]
    texts += [r["text"] for r in odd_docs.collect()]
    whole = Tokenizer.from_file(PATH)
    for width in (2, 4):
        encoder = tokens.Encoder(tokens.load_tokenizer(PATH), width)
        for _ in range(2):
            got = encoder.encode(pa.array(texts, pa.string()))
            assert got == [np.array(whole.encode(t or "", add_special_tokens=False).ids, f"<u{width}").tobytes() for t in texts]


def test_packing(odd_docs):
    cut = packing.pieces(odd_docs, PATH, length=64)
    rows = packing.pack(cut, length=64).collect()
    whole = Tokenizer.from_file(PATH)
    for doc in odd_docs.collect():
        own = sorted((r for r in rows if r["doc_id"] == doc["doc_id"]), key=lambda r: r["piece"])
        ids = np.array([*whole.encode(doc["text"] or "", add_special_tokens=False).ids, 2], "<u4")
        assert b"".join(r["ids"] for r in own) == ids.tobytes() and all(r["length"] == 64 for r in own[1:])
    for of in {r["sequence_id"] for r in rows}:
        at = 0
        for r in sorted((r for r in rows if r["sequence_id"] == of), key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= 64
    whole_rows = packing.sequences(packing.pack(cut, length=64)).collect()
    assert all(len(r["ids"]) == 4 * r["length"] for r in whole_rows)


def test_two_documents_replace_the_smallest():
    patterns = packing.plan({7: 1, 2: 1, 1: 2, 3: 1}, 11)
    assert sum(n for _, n in patterns) == 2 and patterns[0][0] == [7, 3, 1]
    assert packing.plan({6: 1, 3: 1, 2: 2}, 10)[0][0] == [6, 2, 2]


def test_shards(odd_docs):
    rows = sharding.stratified_shards(odd_docs.union(odd_docs), 3).collect()
    sizes = collections.Counter(r["shard"] for r in rows)
    assert sum(sizes.values()) == 20 and max(sizes.values()) - min(sizes.values()) <= 1
    assert all(sorted(r["slot"] for r in rows if r["shard"] == s) == list(range(n)) for s, n in sizes.items())


def test_mixture(odd_docs, make_docs):
    assert {r["doc_id"] for r in curriculum.mix(odd_docs).collect()} <= {3, 4, 5, 6, 7, 8, 9}
    docs = make_docs([f"w {i} " * (i % 7) for i in range(600)], source=lambda i: None if i % 5 == 0 else f"s{i % 3}")
    plan = curriculum.plan_mixture(docs.select("doc_id", "source", curriculum.word_count(F.col("text")).alias("size"))).collect()
    for source in {r["source"] for r in plan}:
        own = [r for r in plan if r["source"] == source]
        assert abs(sum(r["copies"] * r["size"] for r in own) - own[0]["target"]) <= 14
        assert all(0 <= p <= 1 for r in own for p in r["positions"]) and all(len(r["positions"]) == r["copies"] <= 2 for r in own)


def test_records(spark, odd_docs, tmp_path):
    index = records.write_records(odd_docs, str(tmp_path), PATH, file_bytes=64)
    whole, at = Tokenizer.from_file(PATH), 0
    back = {r["doc_id"]: r for r in records.read_records(index.orderBy(F.desc("doc_id")), str(tmp_path)).collect()}
    for doc in odd_docs.orderBy("doc_id").collect():
        ids = np.array([*whole.encode(doc["text"] or "", add_special_tokens=False).ids, 0], "<u4").tobytes()
        assert back[doc["doc_id"]]["ids"] == ids and back[doc["doc_id"]]["start"] == at
        at += len(ids) // 4
    damaged = bytearray(records.frame(b"\1\0\2\0", 2))
    damaged[14] ^= 1
    with pytest.raises(ValueError, match="damaged"):
        records.unframe(bytes(damaged))


def plain_components(texts, size, percent):
    sets = {}
    for i, t in texts.items():
        words = lower(t or "").encode().split()
        n = min(size, len(words))
        sets[i] = {tuple(words[k : k + n]) for k in range(len(words) - n + 1)} if n else set()
    root = {i: i for i in sets}
    for a in sorted(sets):
        for b in sorted(sets):
            if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                old, new = sorted((root[a], root[b]))[::-1]
                root = {k: new if v == old else v for k, v in root.items()}
    return {i: (len(sets[i]), root[i]) for i in sets}


@pytest.mark.parametrize(("size", "percent", "frequent"), [(3, 90, 32), (3, 90, 3), (5, 80, 3)])
def test_ngram_components(make_docs, monkeypatch, size, percent, frequent):
    monkeypatch.setattr(ngram_join, "FREQUENT", frequent)
    monkeypatch.setattr(ngram_join, "BLOCK", 16)
    rng = np.random.default_rng(7)
    base = [f"b{i}" for i in range(150)]
    texts = [None, "", "one", "One", "two words", "x y z"]
    for _ in range(150):
        words = base[: int(rng.integers(20, 150))]
        for k in rng.integers(0, len(words), int(rng.integers(0, 5))):
            words[k] = f"n{rng.integers(0, 6)}"
        texts.append(" ".join(words))
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in ngram_join.ngram_components(make_docs(texts), size, percent).collect()}
    assert got == plain_components(dict(enumerate(texts)), size, percent)


@pytest.mark.parametrize("block", [8, 1_024])
def test_all_links_are_returned(make_docs, odd_docs, monkeypatch, block):
    monkeypatch.setattr(ngram_join, "BLOCK", block)
    rng = np.random.default_rng(11)
    texts = ["", None, "one", "One"]
    for i in range(90):
        words = [f"b{i % 2}x{k}" for k in range(40)]
        for k in rng.integers(0, 40, int(rng.integers(0, 3))):
            words[k] = f"n{rng.integers(0, 3)}"
        texts.append(" ".join(words))
    sets = {}
    for i, t in enumerate(texts):
        own = frozenset(zip(*[(t or "").lower().split()[k:] for k in range(3)])) or frozenset((t or "").lower().split())
        if own and own not in sets.values():
            sets[i] = own
    plain = {(a, b) for a in sets for b in sets if a < b and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])}
    docs = make_docs(texts)
    got = [tuple(r) for r in ngram_join.class_links(docs, 3, 80).collect()]
    assert len(got) == len(set(got)) and set(got) == plain and len(plain) > len(sets)
    counts = {r["doc_id"]: r["n_links"] for r in ngram_join.link_counts(docs, 3, 80).collect()}
    assert counts == {i: sum(i in pair for pair in plain) for i in sets}
    assert ngram_join.class_links(odd_docs.limit(0)).count() == ngram_join.link_counts(odd_docs.limit(0)).count() == 0


@pytest.mark.parametrize("size", [64, 1 << 12])
def test_many_members_go_by_a_bitmap(spark, make_docs, monkeypatch, size):
    monkeypatch.setattr(ngram_join, "BROADCAST_COPIES", 0)
    monkeypatch.setattr(ngram_join.bitmap, "__defaults__", (size,))
    texts = {i: " ".join(f"w{i % 9}x{k}" for k in range(40 + i % 2)) for i in range(60)}
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in ngram_join.ngram_components(make_docs(texts.values()), 3, 80).collect()}
    assert got == plain_components(texts, 3, 80)
    ids = spark.range(-50, 50, 7).select(F.col("id").alias("doc_id"))
    bits = ngram_join.bitmap(ids, size)
    assert len(bits) == size and ngram_join.in_bitmap(np.arange(-50, 50, 7), bits).all()
    assert size == 64 or ngram_join.in_bitmap(np.arange(1_000, 3_000), bits).mean() < 0.01


def test_no_text_is_shuffled(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    plans = []
    real = ngram_join.materialise
    ngram_join.materialise = lambda df: plans.append(df._jdf.queryExecution().executedPlan().toString()) or real(df)
    try:
        plans.append(ngram_join.keep_first(docs, 3, 90)._jdf.queryExecution().executedPlan().toString())
    finally:
        ngram_join.materialise = real
    for plan in plans:
        for line in plan.splitlines():
            assert "Exchange" not in line or "text#" not in line, line
        assert "FileScan" not in plan or "SortMergeJoin" not in plan or "text" not in plan


def test_keep_first_of_repeated_rows(odd_docs):
    kept = sorted(r["doc_id"] for r in ngram_join.keep_first(odd_docs.union(odd_docs)).collect())
    assert kept == [0, 1, 2, 3, 4, 5, 7, 8, 9]


def test_toxicity_on_held_out_rows(spark, sf_dir):
    big = sf_dir.replace("sf0.001", "sf0.1")
    docs, labels = (spark.read.parquet(f"{big}/{t}.parquet") for t in ("documents", "labels"))
    known = docs.join(labels, "doc_id").select("doc_id", "text", "toxic")
    rows = toxicity.score(known, toxicity.train(docs, labels)).filter(toxicity.is_held_out(F.col("doc_id"))).select("toxic", "score").collect()
    hits = [(r["toxic"], r["score"] >= 0.7) for r in rows]
    assert sum(y == p for y, p in hits) / len(hits) > 0.95
    assert sum(y and p for y, p in hits) / sum(y for y, _ in hits) > 0.8


def test_toxicity_without_labels(spark, odd_docs):
    labels = spark.createDataFrame([(3, None)], "doc_id long, toxic int")
    assert {r["score"] for r in toxicity.score(odd_docs, toxicity.train(odd_docs, labels)).collect()} == {0.0}


def test_quality_of_odd_texts(odd_docs):
    got = {r["doc_id"]: r["quality"] for r in quality.assess(odd_docs).collect()}
    assert got[0]["n_words"] == got[2]["n_words"] == 0 and got[4]["n_words"] == 3 and got[9]["lines"]["all"] == 2
    assert not any(r["kept"] for i, r in got.items() if i != 7) and got[7]["n_words"] == 60_000



def test_short_texts_may_repeat_a_line(make_docs):
    own = [" ".join(f"the w{i}x{k}" for k in range(15)) for i in range(9)]
    docs = make_docs(["\n".join([own[0], "a line", "a line"]), "\n".join([*own[:5], *["a line"] * 5]), "\n".join(own)])
    assert sorted(r["doc_id"] for r in quality.keep(docs).collect()) == [0, 2]


def test_stop_words_count_in_listed_languages_only(spark):
    text = " ".join(f"slovo{i}" for i in range(80))
    docs = spark.createDataFrame([(0, text, "en"), (1, text, "cs"), (2, text, None), (3, "the " + text, "de")], "doc_id long, text string, lang string")
    assert [r["doc_id"] for r in quality.keep(docs).collect()] == [1]
    assert quality.keep(docs.drop("lang")).count() == 0
    long = "the word and other words of it " * 150_000
    rules = [r for r in quality.RULES if r.name != "repeated_words"]
    assert quality.assess(docs.limit(1).withColumn("text", F.lit(long)), rules).select("quality.broken").first()[0] == []


def test_licences(make_docs, odd_docs):
    mit, notice = licences.TEMPLATES["MIT"], licences.TEMPLATES["GPL-3.0 notice"]
    filler = " ".join(f"f{i}" for i in range(300))
    changed = mit.replace("merge, publish", "join, print")
    texts = [f"{filler} {mit} {filler}", notice.upper(), f"{filler} {changed}", filler, mit[: len(mit) // 2], None]
    got = {(r["doc_id"], r["licence"]): r["containment"] for r in licences.find_licences(make_docs(texts)).collect()}
    plain = {}
    for i, t in enumerate(texts):
        own = set(licences.shingles(licences.template_words(t or "")))
        for name, text in licences.TEMPLATES.items():
            of = set(licences.shingles(licences.template_words(text)))
            if len(own & of) >= 0.8 * len(of):
                plain[i, name] = len(own & of) / len(of)
    assert got == plain and {(0, "MIT"), (1, "GPL-3.0 notice"), (2, "MIT")} <= set(got)
    assert licences.find_licences(odd_docs).count() == 0



def test_short_licence_lines(make_docs):
    texts = ["All rights reserved.", "x y z. ALL RIGHTS RESERVED", "all the rights reserved", "all rights", "it is under MIT license here"]
    texts += ["Code under the BSD-3-Clause.", "SPDX-License-Identifier: ISC", None, "rights reserved all rights reserved"]
    rows = licences.find_licences(make_docs(texts)).collect()
    found = {(r["doc_id"], r["licence"]): (r["containment"], r["n_shingles"], r["first_word"]) for r in rows}
    line = "All rights reserved"
    assert {i: v for (i, n), v in found.items() if n == line} == {0: (1.0, 1, 0), 1: (1.0, 1, 3), 8: (1.0, 1, 2)}
    assert {i for i, _ in found} == {0, 1, 4, 5, 6, 8}
    assert {n.split(" ")[0] for i, n in found if i in (4, 5, 6)} == {"MIT", "BSD-3-Clause", "ISC"}
    own = licences.find_licences(make_docs(texts), {"one": "rights", "two": "all rights"}).collect()
    assert {(r["doc_id"], r["licence"]) for r in own} == {(i, "one") for i in (0, 1, 2, 3, 8)} | {(i, "two") for i in (0, 1, 3, 8)}


def test_licence_families(make_docs):
    """Every template is found whole in a text that holds it."""
    names = list(licences.TEMPLATES)
    rows = licences.find_licences(make_docs([f"some words {licences.TEMPLATES[n]} and more" for n in names])).collect()
    assert {names[r["doc_id"]] for r in rows if r["licence"] == names[r["doc_id"]] and r["containment"] == 1} == set(names)
    for family in ("BSD-2-Clause", "BSD-3-Clause", "ISC", "GPL-2.0", "LGPL-2.1", "LGPL-3.0", "AGPL-3.0"):
        assert any(n.startswith(family) for n in names)

def test_pipeline_decisions(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    frames = [docs]
    for _, stage in corpus_pipeline.STAGES:
        frames.append(corpus_pipeline.materialise(stage(spark, frames[-1], sf_dir)))
    assert all(f.columns == docs.columns for f in frames[:-1])
    start, good, lined, single, mixed, packed = ({r["doc_id"]: r for r in f.collect()} for f in frames)
    verdicts = {r["doc_id"] for r in contract.queries()["op9_quality_rules"](spark, sf_dir).filter("kept").collect()}
    assert set(good) == verdicts and set(lined) == verdicts
    keys = collections.Counter(k for r in good.values() for k in {lower(x.strip(BLANKS)) for x in r["text"].split("\n")} if k)
    for i, r in good.items():
        left = "\n".join(x for x in r["text"].split("\n") if keys[lower(x.strip(BLANKS))] < 10)
        assert hashlib.sha256(left.encode()).digest() == hashlib.sha256(lined[i]["text"].encode()).digest()
    plain = plain_components({i: r["text"] for i, r in lined.items()}, 5, 80)
    assert set(single) == {i for i, (_, c) in plain.items() if c == i}
    assert set(mixed) <= set(single) and set(packed) == set(mixed)
    lengths = collections.Counter()
    for r in frames[-1].collect():
        lengths[r["sequence_id"]] += r["length"]
    assert max(lengths.values()) <= 1024
    whole = Tokenizer.from_file(PATH)
    for r in frames[-1].collect()[:50]:
        ids = np.array([*whole.encode(mixed[r["doc_id"]]["text"], add_special_tokens=False).ids, 2], "<u4")
        assert zlib.crc32(ids[r["start"] : r["start"] + r["length"]].tobytes()) == r["ids_crc32"]


def test_pipeline_keeps_one_of_many_copies(spark, make_docs):
    copied = "\n".join(" ".join(f"the w{i}x{k}" for k in range(15)) for i in range(4))
    docs = make_docs([copied] * 12 + ["\n".join([copied, f"an own line {i}"]) for i in range(2)] + [" \n"])
    lined = corpus_pipeline.repeated_lines(spark, docs, "")
    got = {r["doc_id"]: (r["text"], r["n_chars"]) for r in lined.collect()}
    assert all(got[i] == (copied, len(copied)) for i in range(12)) and got[12][0] == "an own line 0" and got[14][0] == " \n"
    assert [r["doc_id"] for r in corpus_pipeline.near_duplicates(spark, lined, "").filter("doc_id < 12").collect()] == [0]


CLASHING = (
    "n_lines n_dropped kept_text shard slot position total rank before size rows words key copies positions source_size target score "
    "quality n hi lo cell filter signature component component_id class_id length piece start ids sequence_id offset file part found "
    "toxic fold w b __drop __doc __size"
).split()


@pytest.fixture(scope="module")
def clashing_docs(spark, odd_docs):
    """Odd texts, all rows twice, rows without an id or without anything, and columns named like working names."""
    more = [(None, "without an id", "en", "wordless", None), (None, None, None, None, None), (70, "", "en", "wordless", 0), (71, " ", "en", "wordless", 1)]
    rows = odd_docs.union(odd_docs).union(spark.createDataFrame(more, odd_docs.schema))
    odd = {"a.b": F.lit("own dot"), "marks": F.create_map(F.lit("k"), F.lit(1))}
    return rows.withColumns({**{c: F.lit(f"own {c}") for c in CLASHING}, **odd})


@pytest.mark.parametrize(("name", "stage"), corpus_pipeline.STAGES)
def test_stage_with_clashing_columns(spark, clashing_docs, name, stage):
    got = stage(spark, clashing_docs, "")
    plain = stage(spark, clashing_docs.drop(*CLASHING, "a.b", "marks"), "")
    count = lambda df: collections.Counter(map(tuple, df.select(*plain.columns).collect()))
    assert count(got) == count(plain)
    if stage is not corpus_pipeline.STAGES[-1][1]:
        assert got.columns == clashing_docs.columns
        assert {r["kept_text"] for r in got.select("kept_text").collect()} <= {"own kept_text"}


def test_operators_with_clashing_columns(spark, clashing_docs, tmp_path):
    n = clashing_docs.count()
    cleaned = line_dedup.dedup_lines(clashing_docs, min_docs=1_000)
    assert sorted(r["kept_text"] for r in cleaned.collect()) == sorted(r["text"] or "" for r in clashing_docs.collect())
    placed = sharding.stratified_shards(clashing_docs, 3)
    assert set(placed.columns) == set(clashing_docs.columns)
    assert len({(r["shard"], r["slot"]) for r in placed.collect()}) == n
    assert {r["score"] for r in toxicity.score(clashing_docs, toxicity.Model(0.25)).collect()} == {0.25}
    assert quality.assess(clashing_docs).select("quality.n_words").count() == n
    index = records.write_records(clashing_docs, str(tmp_path), PATH)
    assert records.read_records(index, str(tmp_path)).count() == n
    found = ngram_join.ngram_components(clashing_docs, 3, 90)
    assert found.count() == n and found.filter("doc_id IS NULL AND component_id IS NOT NULL").count() == 0
    again = packing.pack(packing.pack(packing.pieces(clashing_docs, PATH)))
    assert again.columns[-2:] == ["sequence_id", "offset"] and again.filter("piece = 0").count() == n
    assert licences.find_licences(clashing_docs.withColumn("text", F.lit(licences.TEMPLATES["MIT"]))).filter("licence = 'MIT'").count() == 13


def test_top_k_leaves_out_rows_without_an_id(spark):
    rows = [(None, [9.0, 9.0]), (0, [1.0, 0.0]), (1, [0.5, 0.0]), (2, [2.0, 0.0]), (2, [2.0, 0.0])]
    got = topk.top_k(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), F.col("vec_id") == 0, k=3).collect()
    assert [(r["vec_id"], r["rank"]) for r in sorted(got, key=lambda r: r["rank"])] == [(2, 1), (2, 2), (1, 3)]


def test_blocks_bounded_by_tokens(make_docs, monkeypatch):
    monkeypatch.setattr(ngram_join, "FREQUENT", 3)
    monkeypatch.setattr(ngram_join, "BLOCK_TOKENS", 200)
    rng = np.random.default_rng(3)
    texts = []
    for _ in range(120):
        words = [f"b{i}" for i in range(int(rng.integers(30, 60)))]
        for k in rng.integers(0, len(words), int(rng.integers(0, 4))):
            words[k] = f"n{rng.integers(0, 3)}"
        texts.append(" ".join(words))
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in ngram_join.ngram_components(make_docs(texts), 3, 80).collect()}
    assert got == plain_components(dict(enumerate(texts)), 3, 80)


def test_sequences_follow_the_training_order(spark, make_docs, tmp_path):
    rng = np.random.default_rng(5)
    texts = [" ".join(f"w{k}" for k in rng.integers(0, 500, rng.integers(1, 120))) for _ in range(600)]
    texts[100], texts[200] = " ".join(f"long {k}" for k in range(3_000)), None
    docs = make_docs(texts).repartitionByRange(7, "doc_id").sortWithinPartitions("doc_id")
    stored = corpus_pipeline.materialise(docs)
    numbered = {r["doc_id"]: r["__place"] for r in packing.in_file_order(stored).select("doc_id", "__place").collect()}
    assert numbered == {i: i for i in range(600)}
    cut = packing.pieces(packing.in_file_order(stored), PATH, length=256, keep=["__place"])
    packed = corpus_pipeline.materialise(packing.pack_in_order(cut, length=256, rows=50))
    rows = packed.collect()
    inside = collections.defaultdict(list)
    for r in rows:
        inside[r["sequence_id"]].append(r)
    for members in inside.values():
        at = 0
        for r in sorted(members, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= 256 and max(r["doc_id"] for r in members) // 50 == min(r["doc_id"] for r in members) // 50
    order = [min(r["doc_id"] for r in inside[i]) for i in sorted(inside)]
    assert order == sorted(order)
    assert np.corrcoef([r["doc_id"] for r in rows], [r["sequence_id"] for r in rows])[0, 1] > 0.99
    # Two sequences at most half full would have been one, so a stretch has one of them at most.
    half = collections.Counter(m[0]["doc_id"] // 50 for m in inside.values() if 2 * sum(r["length"] for r in m) <= 256)
    assert max(half.values(), default=0) <= 1
    # Whole sequences as records, read back in any order.
    whole = packing.sequences(packed)
    index = records.write_ids(whole.selectExpr("sequence_id AS doc_id", "ids"), str(tmp_path / "records"), 2)
    back = {r["doc_id"]: r["ids"] for r in records.read_records(index.orderBy(F.xxhash64("doc_id")), str(tmp_path / "records")).collect()}
    library, plain = Tokenizer.from_file(PATH), {}
    for i, members in inside.items():
        ids = []
        for r in sorted(members, key=lambda r: r["offset"]):
            of = [*library.encode(texts[r["doc_id"]] or "", add_special_tokens=False).ids, 2]
            ids += of[r["start"] : r["start"] + r["length"]]
        plain[i] = np.array(ids, "<u4").tobytes()
    assert {i: bytes(b) for i, b in back.items()} == plain


def test_records_of_wide_ids_are_refused(spark, tmp_path):
    rows = spark.createDataFrame([(1, bytearray(np.array([70_000], "<u4").tobytes()))], "doc_id bigint, ids binary")
    with pytest.raises(Exception, match="does not fit"):
        records.write_ids(rows, str(tmp_path), 2)


def test_tokens_are_shuffled_once_for_their_counts_and_the_join(spark):
    from tripflow.llm import ngram_join

    words = [f"w{k % 37} x{k % 11} y{k}" for k in range(60)]
    rows = [(d, " ".join(words[d % 3 :])) for d in range(20)] + [(90, "only here are these words"), (90, "only here are these words")]
    signed = ngram_join.materialise(ngram_join.signed_sets(spark.createDataFrame(rows, "doc_id long, text string"), 3, 90))
    index = ngram_join.signature_index(signed.filter("n > 1 AND doc_id IS NOT NULL"), 90)
    held = {r.doc_id for r in index.collect()}
    assert held and 90 not in held  # tokens that only repeated rows of one id have are not shared
    index.collect()
    plan = index._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ReusedExchange") >= 1 and "REPARTITION_BY_COL" in plan


@pytest.mark.parametrize("percent", [80, 90])
def test_marks_never_rule_out_a_link(percent):
    rng = np.random.default_rng(13)
    ruled_out = 0
    for n in [1, 2, 63, 64, 65, 130, 500, 1_020, 1_030, 5_000]:
        for lost in range(0, n // 3 + 1, max(1, n // 40)):
            x = np.unique(rng.integers(0, 1 << 63, n).astype(np.uint64))
            added = rng.integers(0, 1 << 63, int(rng.integers(0, lost + 1))).astype(np.uint64)
            y = np.unique(np.concatenate([x[lost:], added]))
            shared = len(np.intersect1d(x, y))
            marks = (np.frombuffer(ngram_join.mark_of(s), "<u8") for s in (x, y))
            if 100 * shared >= percent * (len(x) + len(y) - shared):
                assert ngram_join.may_be_linked(*marks, len(x) + len(y), percent)
        far = (np.frombuffer(ngram_join.mark_of(rng.integers(0, 1 << 63, n).astype(np.uint64)), "<u8") for _ in range(2))
        ruled_out += n > 60 and not ngram_join.may_be_linked(*far, 2 * n, percent)
    assert ruled_out == 8


def test_sets_far_apart_are_not_moved(make_docs, monkeypatch):
    """Texts with a few rare passages in common share signatures, but their whole sets are not read for it."""
    rng = np.random.default_rng(17)
    texts = []
    for i in range(40):
        words = [f"t{i}x{k}" for k in range(150)]
        for p in rng.choice(12, 6, replace=False):
            words[12 * p : 12 * p + 12] = [f"passage{p} word{k}" for k in range(12)]
        texts.append(" ".join(words))
    texts += [texts[0] + " end", texts[1] + " end"]
    read, real = [], ngram_join.member_sets
    monkeypatch.setattr(ngram_join, "member_sets", lambda d, m, size: read.extend(r[0] for r in m.collect()) or real(d, m, size))
    got = {r["doc_id"]: r["component_id"] for r in ngram_join.ngram_components(make_docs(texts), 3, 90).collect()}
    assert got == {i: i for i in range(40)} | {40: 0, 41: 1}
    assert {0, 1, 40, 41} <= set(read) and len(set(read)) < 20


def test_python_gets_small_batches_for_sets(spark, make_docs, monkeypatch):
    from tripflow.session import small_batches

    keys = ["spark.sql.execution.arrow.maxRecordsPerBatch", "spark.sql.execution.arrow.maxBytesPerBatch"]
    before = [spark.conf.get(k) for k in keys]
    held, real = [], ngram_join.materialise
    monkeypatch.setattr(ngram_join, "materialise", lambda df: held.append(spark.conf.get(keys[0])) or real(df))
    ngram_join.ngram_components(make_docs(["a b c d", "a b c d", None]), 3, 90)
    assert held[0] == "1024" and "1024" in held[1:]
    with pytest.raises(ZeroDivisionError), small_batches(spark, 5, 2_000):
        with small_batches(spark, 9, 3_000):
            assert [spark.conf.get(k) for k in keys] == ["5", "2000"]
        docs = spark.range(0, 40, 1, 1).selectExpr("id", "repeat('x', 100) AS text")
        sizes = docs.mapInArrow(lambda batches: (b.select(["id"]).slice(0, 1) for b in batches), "id long").collect()
        assert len(sizes) == 8  # 40 rows, five at once
        1 / 0
    assert [spark.conf.get(k) for k in keys] == before
