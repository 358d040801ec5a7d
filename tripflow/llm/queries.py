"""The registered queries of this package, over whole tables, and the SQL of those that SQL can state."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripflow.llm import (
    alignment, curriculum, filter_audit, licences, line_dedup, ngram_join, packing, quality, records, secret_scan, sharding, topk,
    toxicity,
)
from tripflow.plans.base import QueryFn, table

QUERIES: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")

# SQL for the words of a text.
SQL_WORDS = "regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')"


def query(name: str, sql: str | None = None):
    def register(fn: QueryFn) -> QueryFn:
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


@query(
    "op1_line_dedup",
    """
    WITH split AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents),
    lines AS (SELECT doc_id, unnest(l) AS line, generate_subscripts(l, 1) AS i FROM split),
    keyed AS (
        SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
        FROM lines),
    hot AS (SELECT k AS h FROM keyed WHERE length(k) >= 1 GROUP BY k HAVING count(DISTINCT doc_id) >= 10)
    SELECT doc_id, count(*) AS n_lines, count(h) AS n_dropped,
        sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE h IS NULL), '')) AS kept_sha256
    FROM keyed LEFT JOIN hot ON k = h GROUP BY doc_id
    """,
)
def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = line_dedup.dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"), min_docs=10, min_chars=1)
    return cleaned.select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


@query(
    "op2_exact_top_k",
    """
    WITH v AS (
        SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS q FROM embeddings
        WHERE len(list_filter(embedding, lambda x: isfinite(x))) = len(embedding)),
    s AS (
        SELECT a.vec_id AS query_id, b.vec_id, CAST(list_dot_product(a.q, b.q) AS BIGINT) AS score
        FROM v a, v b WHERE a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id AND len(a.q) = len(b.q))
    SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
        vec_id, score
    FROM s QUALIFY rank <= 5
    """,
)
def op2_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, k=5, scale=256)


@query("op3_best_fit_packing")
def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = packing.pieces(table(spark, sf_dir, "documents"), TOKENIZER, length=1024, end_id=2)
    return packing.pack(cut.withColumn("ids_crc32", F.crc32("ids")).drop("ids"), length=1024)


@query("op4_stratified_shards")
def op4_stratified_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = table(spark, sf_dir, "documents").select(
        "doc_id", "source", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32")
    )
    placed = sharding.stratified_shards(rows, 16)
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


@query(
    "op5_curriculum_mix",
    f"""
    WITH d AS (SELECT doc_id, source, len({SQL_WORDS}) AS size, md5('50:' || doc_id) AS key FROM documents),
    s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
    w AS (
        SELECT *, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS schedule,
            [3.0::DOUBLE, 1.0::DOUBLE, 2.0::DOUBLE][schedule + 1] AS weight, 2 * source_size AS bound, bound / weight AS ratio
        FROM s),
    c AS (
        SELECT *, 1.5::DOUBLE * sum(source_size) OVER () AS total,
            (total - coalesce(sum(bound) OVER (ORDER BY ratio, source NULLS LAST
                ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
            / sum(weight) OVER (ORDER BY ratio, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)
            >= ratio AS cut
        FROM w),
    t AS (
        SELECT *, CAST(CASE WHEN cut THEN bound ELSE weight * (total - coalesce(sum(CASE WHEN cut THEN bound END) OVER (), 0))
            / sum(CASE WHEN NOT cut THEN weight END) OVER () END AS DOUBLE) AS target
        FROM c),
    m AS (
        SELECT doc_id, size, source_size, target, schedule, coalesce(sum(size) OVER (PARTITION BY source ORDER BY key, doc_id
            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) + size / 2 AS middle
        FROM d JOIN t USING (source)),
    p AS (
        SELECT *, CASE WHEN size = 0 THEN 0
            ELSE least(greatest(floor((target - middle) / source_size) + 1, 0), 2) END AS n,
            [4.0::DOUBLE, 1.0::DOUBLE, 1.0::DOUBLE][schedule + 1] AS w0,
            [-2.0::DOUBLE, 0.0::DOUBLE, 2.0::DOUBLE][schedule + 1] AS slope,
            middle / target * [3.0::DOUBLE, 1.0::DOUBLE, 2.0::DOUBLE][schedule + 1] AS rest
        FROM m)
    SELECT doc_id, size, source_size, target, CAST(n * size AS BIGINT) AS taken,
        CASE WHEN n > 0 THEN 2 * rest / (w0 + sqrt(greatest(w0 * w0 + 2 * slope * rest, 0.0::DOUBLE))) END AS position
    FROM p
    """,
)
def op5_curriculum_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", curriculum.word_count(F.col("text")).alias("size"))
    plan = curriculum.plan_mixture(docs).withColumn("position", F.get("positions", F.lit(0)))
    rows = plan.withColumn("row", F.explode(F.sequence(F.lit(1), F.col("rows"))))
    rows = rows.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"), "position")
    return curriculum.by_position(rows, "position", ["doc_id"])


@query("op6_token_records")
def op6_token_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    back = records.round_trip(table(spark, sf_dir, "documents"), TOKENIZER)
    return back.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


@query("op7_ngram_jaccard")
def op7_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = ngram_join.ngram_components(table(spark, sf_dir, "documents"), size=3, percent=90)
    return found.select("doc_id", "n_shingles", "component_id", "class_id")


@query("op8_toxicity")
def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    scored = toxicity.score(docs, model).withColumn("held_out", toxicity.is_held_out(F.col("doc_id")))
    return scored.select("doc_id", "held_out", "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


@query(
    "op9_quality_rules",
    f"""
    WITH w AS (SELECT doc_id, lang, coalesce(text, '') AS text, {SQL_WORDS} AS w FROM documents),
    g AS (
        SELECT doc_id, unnest(list_transform(range(1, len(w) - 6), lambda i: array_to_string(w[i : i + 7], ' '))) AS gram,
            unnest(range(1, len(w) - 6)) AS i
        FROM w WHERE len(w) >= 8),
    twice AS (SELECT doc_id, i FROM g QUALIFY count(*) OVER (PARTITION BY doc_id, gram) > 1),
    covered AS (
        SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + 8)) AS p FROM twice) GROUP BY doc_id),
    lines AS (
        SELECT doc_id, count(*) AS n_lines, count(*) - count(DISTINCT l) AS n_dup
        FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS l FROM w)
        WHERE regexp_matches(l, '[^\\x20\\x09-\\x0D]') GROUP BY doc_id),
    m AS (
        SELECT w.doc_id, w.lang, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
            len(regexp_extract_all(text, '[#*$%&|<>]')) AS n_symbols, coalesce(n_dup, 0) AS n_dup_lines,
            coalesce(n_lines, 0) AS n_lines, coalesce(covered.n, 0) AS n_repeat_words,
            len(list_filter(w, lambda x: list_contains({list(quality.STOP_WORDS)}, lower(x)))) AS n_stop,
            greatest(len(w), 1) AS d
        FROM w LEFT JOIN covered USING (doc_id) LEFT JOIN lines USING (doc_id)),
    b AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM m)
    SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
        NOT base_failed AND word_chars / d BETWEEN 2.5 AND 12.0 AND n_symbols / d <= 0.1
        AND (n_words < 50 OR n_stop / d >= 0.02 OR NOT coalesce(lower(lang) IN {quality.LISTED}, true))
        AND (n_lines < 8 OR n_dup_lines / n_lines <= 0.3) AS kept
    FROM b
    """,
)
def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    q = quality.assess(table(spark, sf_dir, "documents").select("doc_id", "text", "lang"))
    names = ("n_words", "word_chars", "n_symbols", "n_repeat_words", "base_failed", "kept")
    return q.select("doc_id", F.col("quality.lines.dup").alias("n_dup_lines"), *[F.col(f"quality.{n}").alias(n) for n in names])


@query("op10_licence_scan")
def op10_licence_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.find_licences(table(spark, sf_dir, "documents"))


@query("op11_secret_scan")
def op11_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = secret_scan.scan(docs, secret_scan.train(docs))
    listed = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    base = F.filter("spans", lambda s: s["kind"] != secret_scan.KINDS[-1])
    return found.select(
        "doc_id", "n_assign", "n_access", "n_hex", "n_crf", F.sha2(listed(base), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans")
    )


@query("op12_token_alignment")
def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    both = alignment.Tokenizers.load(TOKENIZER, PIECES)
    counted = alignment.align_and_count(table(spark, sf_dir, "documents").select("doc_id", "text"), both)
    return counted.withColumnRenamed("groups", "groups_sha256")


@query(
    "op13_filter_audit",
    f"""
    WITH w AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t, {SQL_WORDS} AS words FROM documents),
    l AS (SELECT doc_id, max(CAST(quality = 1 AS INTEGER)) AS good, max(CAST(toxic = 1 AS INTEGER)) AS toxic
        FROM labels GROUP BY doc_id),
    m AS (
        SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
            CAST(len(words) < 100 AS INTEGER) + 2 * CAST(100 * len(list_distinct(words)) < 80 * len(words) AS INTEGER)
            + 4 * CAST(100 * len(regexp_extract_all(t, '[A-Z]')) > 10 * length(t) AS INTEGER)
            + 8 * CAST(regexp_matches(t, '[#$%&*|]') AS INTEGER)
            + 16 * CAST(coalesce(doc_id > min(doc_id) OVER (PARTITION BY t), false) AS INTEGER) AS fails
        FROM w LEFT JOIN l USING (doc_id)),
    c AS (SELECT part, fails, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM m GROUP BY part, fails),
    f AS (SELECT x, 1 << CAST(i AS INTEGER) AS b FROM (VALUES ('A', 0), ('B', 1), ('C', 2), ('D', 3), ('E', 4)) v(x, i)),
    o AS (
        SELECT f1.x || f2.x || f3.x || f4.x || f5.x AS filter_order, [f1.b, f2.b, f3.b, f4.b, f5.b] AS bits
        FROM f f1, f f2, f f3, f f4, f f5 WHERE (f1.b | f2.b | f3.b | f4.b | f5.b) = 31),
    s AS (
        SELECT filter_order, step, bits[step] AS b, list_sum(bits[:step]) AS after, list_sum(bits[:step]) - bits[step] AS before
        FROM o, (SELECT unnest(range(1, 6)) AS step)),
    r AS (
        SELECT part, filter_order, CAST(step AS INTEGER) AS step, b,
            sum(CASE WHEN fails & after = 0 THEN n ELSE 0 END) AS kept,
            sum(CASE WHEN fails & before = 0 AND fails & b <> 0 THEN n ELSE 0 END) AS removed,
            sum(CASE WHEN fails & before <> 0 AND fails & b <> 0 THEN n ELSE 0 END) AS redundant,
            sum(CASE WHEN fails = b THEN n ELSE 0 END) AS unique_fails,
            sum(CASE WHEN fails & before = 0 AND fails & b <> 0 THEN good ELSE 0 END) AS good_lost,
            sum(CASE WHEN fails & before = 0 AND fails & b <> 0 THEN toxic ELSE 0 END) AS toxic_lost
        FROM c, s GROUP BY part, filter_order, step, b)
    SELECT part, filter_order, step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
        CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails,
        CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
        CAST(sum(removed) OVER (PARTITION BY part, b) AS BIGINT) AS shapley
    FROM r
    """,
)
def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
