"""Quality rules: a table of thresholds compiled into one projection.

Everything is built of Spark's own functions and read in one pass without a
shuffle. Defined results: a null or empty text has no words and fails; a
repeated row is judged like its copy; ties cannot occur; an empty table gives
an empty table; further columns are kept where `keep` is used and may have any
name, since the measures live in a struct of their own.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Characters that separate words: space and 09 to 0D.
BLANKS = " \t\n\x0b\f\r"
SYMBOLS = "[#*$%&|<>]"
GRAM = 8

# Frequent function words of the four languages of the corpus.
STOP_WORDS = (
    "a an and are as at be by for from has have he her his in is it its not of on or that the this to was were with "
    "au aux ce dans de des du elle en est et il la le les mais ne nous ou par pas pour que qui se sur un une vous "
    "auf aus bei das dem den der des die ein eine er es für im ist mit nicht sich sie und von werden wie zu zum "
    "al como con del el esta la las lo los más no para pero por que se sin su una y ya"
).split()


@dataclass(frozen=True)
class Rule:
    """A measure that must lie between two bounds, in texts of at least `from_words` words and `from_lines` lines.

    A rule with languages holds for texts of these only, where the rows tell their language.
    """

    name: str
    measure: str
    low: float | None = None
    high: float | None = None
    from_words: int = 0
    from_lines: int = 0
    languages: tuple[str, ...] = ()


# The languages of the stop words.
LISTED = ("en", "fr", "de", "es")

# Ratios over short texts vary by chance, so some rules hold from a length on: one line that occurs twice is a third of three lines.
RULES = (
    Rule("length", "n_words", 20),
    Rule("word_length", "mean_word_length", 2.5, 12.0),
    Rule("symbols", "symbol_ratio", None, 0.1),
    Rule("stop_words", "stop_word_ratio", 0.02, None, 50, languages=LISTED),
    Rule("duplicate_lines", "dup_line_ratio", None, 0.3, from_lines=8),
    Rule("repeated_words", "repeat_word_ratio", None, 0.3),
)


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body(value)` with the value computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def words_of(text: Column) -> Column:
    """The words of a text; one empty string if there is none."""
    return F.split(F.btrim(F.coalesce(text, F.lit("")), F.lit(BLANKS)), "[ \\t-\\r]+")


def _covered(grams: Column) -> Column:
    """Words inside windows whose hash occurs twice or more."""

    def spans(places: Column) -> Column:
        steps = F.transform(places, lambda p, j: F.least(F.lit(GRAM), F.coalesce(F.get(places, j + 1) - p, F.lit(GRAM))))
        return F.aggregate(steps, F.lit(0), lambda a, x: a + x)

    def twice(ordered: Column) -> Column:
        kept = F.filter(
            ordered,
            lambda s, j: F.coalesce(F.get(ordered, j - 1)["g"] == s["g"], F.lit(False))
            | F.coalesce(F.get(ordered, j + 1)["g"] == s["g"], F.lit(False)),
        )
        return bind(F.sort_array(F.transform(kept, lambda s: s["i"])), spans)

    pairs = F.transform(grams, lambda g, i: F.struct(g.alias("g"), i.alias("i")))
    return F.when(F.size(F.array_distinct(grams)) == F.size(grams), F.lit(0)).otherwise(bind(F.sort_array(pairs), twice))


def _repeated(words: Column, n_words: Column) -> Column:
    """Words in windows of eight that occur twice or more; windows are told apart by 64-bit hashes."""
    starts = F.sequence(F.lit(0), n_words - GRAM)
    grams = F.transform(starts, lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(GRAM)]))
    return F.when(n_words > GRAM, bind(grams, _covered)).otherwise(F.lit(0))


def measures(text: Column) -> Column:
    """One struct with the counts of a text."""
    lines = F.filter(F.split(F.coalesce(text, F.lit("")), "\n"), lambda x: F.btrim(x, F.lit(BLANKS)) != "")

    def of(words: Column) -> Column:
        n_words = F.when(F.get(words, F.lit(0)) == "", F.lit(0)).otherwise(F.size(words))
        return F.struct(
            n_words.cast("long").alias("n_words"),
            F.length(F.array_join(words, "")).cast("long").alias("word_chars"),
            F.regexp_count(F.coalesce(text, F.lit("")), F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
            bind(lines, lambda x: F.struct(F.size(x).cast("long").alias("all"), (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("dup"))).alias("lines"),
            bind(n_words, lambda n: _repeated(words, n)).cast("long").alias("n_repeat_words"),
            F.size(F.filter(words, lambda w: F.lower(w).isin(*STOP_WORDS))).cast("long").alias("n_stop_words"),
        )

    return bind(words_of(text), of)


def ratios(m: Column) -> dict[str, Column]:
    """The measures that rules may name."""
    words = F.greatest(m["n_words"], F.lit(1))
    return {
        "n_words": m["n_words"],
        "mean_word_length": m["word_chars"] / words,
        "symbol_ratio": m["n_symbols"] / words,
        "stop_word_ratio": m["n_stop_words"] / words,
        "dup_line_ratio": m["lines"]["dup"] / F.greatest(m["lines"]["all"], F.lit(1)),
        "repeat_word_ratio": m["n_repeat_words"] / words,
    }


def broken_rules(m: Column, rules: Sequence[Rule] = RULES, lang: Column | None = None) -> Column:
    """The names of the rules that a text breaks; a text of unknown language is held to the rules of all."""
    values = ratios(m)
    checks = []
    for rule in rules:
        value = values[rule.measure]
        bad = F.lit(False)
        if rule.low is not None:
            bad = bad | (value < rule.low)
        if rule.high is not None:
            bad = bad | (value > rule.high)
        bad = bad & (m["n_words"] >= rule.from_words)
        if rule.from_lines:
            bad = bad & (m["lines"]["all"] >= rule.from_lines)
        if rule.languages and lang is not None:
            bad = bad & F.coalesce(F.lower(lang).isin(*rule.languages), F.lit(True))
        checks.append(F.when(bad, F.lit(rule.name)))
    return F.array_compact(F.array(*checks))


def base_failed(m: Column) -> Column:
    return (m["n_words"] < 20) | (100 * m["n_repeat_words"] > 30 * m["n_words"])


def _language(docs: DataFrame) -> Column | None:
    return F.col("lang").cast("string") if "lang" in docs.columns else None


def assess(docs: DataFrame, rules: Sequence[Rule] = RULES, text: str = "text", out: str = "quality") -> DataFrame:
    """Adds a struct with all counts, the broken rules and the verdict `kept`; a column `lang` tells the language."""
    lang = _language(docs)

    def judged(m: Column) -> Column:
        broken, failed = broken_rules(m, rules, lang), base_failed(m)
        verdict = m.withField("broken", broken).withField("base_failed", failed)
        return verdict.withField("kept", ~failed & (F.size(broken) == 0))

    return docs.withColumn(out, bind(measures(F.col(text)), judged))


def keep(docs: DataFrame, rules: Sequence[Rule] = RULES, text: str = "text") -> DataFrame:
    """The documents that pass, with the columns they came with.

    The condition binds the measures once: a filter over a projected struct
    would compute them anew for every rule that reads them.
    """
    lang = _language(docs)
    return docs.filter(bind(measures(F.col(text)), lambda m: ~base_failed(m) & (F.size(broken_rules(m, rules, lang)) == 0)))
