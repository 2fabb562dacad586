"""Quality rules as a short-circuit cascade (DataFrame functions only).

Every rule is a predicate that rejects a text, with the number of units (characters or
words) its evaluation looks at. On a bounded sample, drawn by a hash of the id, one
aggregate estimates each rule's selectivity (share of texts rejected) and cost (mean
units). Rules are then tried in the order of rejection per cost, as one CASE expression:
a row stops at the first rule that rejects it, so later rules are not evaluated for it.
The order changes the work, never the verdict.

Base measures of a text: words and their code points, symbols, lines that repeat an
earlier line, and words inside three-word windows that occur more than once. The last
one sorts the window hashes of a text (with the position in the low bits up to 65,536
words, as pairs beyond) and adds up what the repeated windows cover.

Defined cases: a null text has no words and fails the base. An empty table gives an empty
result. Repeated rows are judged alike. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarmac.llm.common import WORD, draw

SAMPLE_DOCS = 2000
MIN_WORDS = 50
MAX_REPEATED = 50  # per cent of words
WINDOW = 3
_LOW_BITS = 16


@dataclass(frozen=True)
class Rule:
    name: str
    rejects: Column
    units: Column


def chars(text: Column, kept: str) -> Column:
    """Number of characters of the class ``kept`` (regular expression, without brackets)."""
    return F.length(F.regexp_replace(text, f"[^{kept}]+", "")).cast("long")


def default_rules() -> list[Rule]:
    """Rules over the base measures and ``text``; ratios as products of integers."""
    text, words = F.col("text"), F.col("n_words")
    n_chars = F.length(text).cast("long")
    return [
        Rule("symbols", F.col("n_symbols") * 10 > words, F.lit(1.0)),
        Rule("word_length", (F.col("word_chars") > words * 14) | (F.col("word_chars") < words * 2), F.lit(1.0)),
        Rule("repeated_lines", F.col("n_dup_lines") * 2 > chars(text, "\\n") + 1, n_chars),
        Rule("shouting", chars(text, "A-Z") * 3 > F.col("word_chars"), n_chars),
        Rule("exclamations", chars(text, "!") * 4 > words, n_chars),
        Rule("digits", chars(text, "0-9") * 2 > F.col("word_chars"), n_chars),
    ]


def estimates(rows: DataFrame, rules: Sequence[Rule], sample_docs: int = SAMPLE_DOCS, n_rows: int | None = None,
              seed: int = 9) -> dict[str, tuple[float, float]]:
    """(selectivity, cost) of each rule on about ``sample_docs`` rows; one small row of
    averages reaches the driver."""
    rate = min(1.0, sample_docs / max(1, rows.count() if n_rows is None else n_rows))
    sample = rows.filter(draw(F.col("doc_id"), seed) < rate)
    got = sample.agg(*(F.avg(F.coalesce(r.rejects, F.lit(False)).cast("int")).alias(f"s{i}") for i, r in enumerate(rules)),
                     *(F.avg(r.units.cast("double")).alias(f"c{i}") for i, r in enumerate(rules))).first()
    return {r.name: (got[f"s{i}"] or 0.0, max(got[f"c{i}"] or 0.0, 1.0)) for i, r in enumerate(rules)}


def cascade_order(rules: Sequence[Rule], measured: dict[str, tuple[float, float]]) -> list[Rule]:
    """Rules by rejection per cost, highest first; ties by cost, then by name."""
    return sorted(rules, key=lambda r: (-measured[r.name][0] / measured[r.name][1], measured[r.name][1], r.name))


def first_rejection(ordered: Sequence[Rule]) -> Column:
    """Name of the first rule that rejects, null if none does (evaluated lazily)."""
    out = F.lit(None).cast("string")
    for rule in reversed(ordered):
        out = F.when(F.coalesce(rule.rejects, F.lit(False)), rule.name).otherwise(out)
    return out


def base_measures(docs: DataFrame) -> DataFrame:
    """doc_id, text and the base measures of every whole text."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    step = docs.select("doc_id", text.alias("text"), F.regexp_extract_all(text, F.lit(WORD), F.lit(0)).alias("words"),
                       F.filter(F.split(text, "\n"), lambda x: x.rlike(WORD)).alias("lines"))
    step = step.select("doc_id", "text", "words", F.size("words").alias("n"),
                       (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"))
    starts = F.when(F.col("n") >= WINDOW, F.sequence(F.lit(0), F.col("n") - WINDOW)).otherwise(F.array().cast("array<int>"))
    window = lambda i: F.xxhash64(*(F.col("words")[i + k] for k in range(WINDOW)))
    low = (1 << _LOW_BITS) - 1
    fits = F.col("n") <= low
    step = step.select(
        "doc_id", "text", "n", "n_dup_lines",
        F.aggregate("words", F.lit(0).cast("long"), lambda s, w: s + F.length(w)).alias("word_chars"),
        F.when(fits, F.sort_array(F.transform(starts, lambda i: window(i).bitwiseAND(F.lit(~low)).bitwiseOR(i.cast("long"))))).alias("marked"),
        F.when(~fits, F.sort_array(F.transform(starts, lambda i: F.struct(window(i).alias("h"), i.cast("long").alias("i"))))).alias("pairs"))
    same = lambda a, b: F.shiftright(a, _LOW_BITS) == F.shiftright(b, _LOW_BITS)
    repeats = F.transform(F.filter("marked", lambda x, j: same(x, F.get("marked", j - 1)) | same(x, F.get("marked", j + 1))),
                          lambda x: x.bitwiseAND(F.lit(low).cast("long")))
    long_repeats = F.transform(F.filter("pairs", lambda x, j: (x["h"] == F.get("pairs", j - 1)["h"]) | (x["h"] == F.get("pairs", j + 1)["h"])),
                               lambda x: x["i"])
    step = step.select("doc_id", "text", "n", "n_dup_lines", "word_chars", F.sort_array(F.coalesce(repeats, long_repeats)).alias("at"))
    covered = F.aggregate(F.transform("at", lambda p, j: F.least(F.lit(WINDOW).cast("long"), F.coalesce(F.get("at", j + 1) - p, F.lit(WINDOW).cast("long")))),
                          F.lit(0).cast("long"), lambda s, x: s + x)
    return step.select("doc_id", "text", F.col("n").cast("long").alias("n_words"), "word_chars",
                       chars(F.col("text"), "#*$%&|<>").alias("n_symbols"), "n_dup_lines", covered.alias("n_repeat_words"))


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (F.col("n_repeat_words") * 100 > F.col("n_words") * MAX_REPEATED)


def judge(docs: DataFrame, rules: Sequence[Rule] | None = None, sample_docs: int = SAMPLE_DOCS) -> DataFrame:
    """Base measures, base_failed, kept and rejected_by of every row."""
    rules = default_rules() if rules is None else rules
    ordered = cascade_order(rules, estimates(base_measures(docs), rules, sample_docs, docs.count()))
    measured = base_measures(docs).withColumn("base_failed", base_failed())
    judged = measured.withColumn("rejected_by", F.when(F.col("base_failed"), "base").otherwise(first_rejection(ordered)))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
                         F.col("rejected_by").isNull().alias("kept"), "rejected_by")
