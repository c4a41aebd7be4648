"""Quality rules: a threshold table compiled into one Spark projection, without user functions.

Counts come first, by built-in string and array functions; the table of :data:`RULES` then becomes one
boolean expression over ratios of these counts.

Words are runs without space or U+0009..U+000D.  A word is repeated if a three-word window that covers it
occurs twice or more in the text; windows are compared by a 64-bit hash of three 64-bit word hashes, within one
document only.

Defined results: null and empty texts have no words, all counts 0, ``base_failed`` and so not ``kept``; each row is
judged alone, so repeated rows and clashing extra columns change nothing (extra columns are kept by
:func:`quality_counts`, its own columns win).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import read_documents, sheltered

SPACES = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
# Frequent function words of the corpus languages, and English ones of common web-text filters.
STOP_WORDS = (
    "the be to of and that have with a in is it for as was on by he or an "
    "de la le les et des un une que en el los las y del se por con der die das und ist von zu den mit du au il elle pour qui dans est"
).split()


@dataclass(frozen=True)
class Rule:
    """``low <= numerator / denominator <= high``; a zero denominator passes."""

    name: str
    numerator: str
    denominator: str
    low: float | None = None
    high: float | None = None


#: The production table.
RULES = (
    Rule("word_length", "word_chars", "n_words", 2.0, 15.0),
    Rule("symbols_per_word", "n_symbols", "n_words", None, 0.1),
    Rule("exclamations_per_word", "n_exclamations", "n_words", None, 0.3),
    Rule("stop_words", "n_stop_words", "n_words", 0.05, None),
    Rule("repeated_lines", "n_dup_lines", "n_lines", None, 0.3),
)


def without(text: Column, chars: str) -> Column:
    return F.translate(text, chars, "")


def quality_counts(docs: DataFrame, text: str = "text", stop_words: list[str] | None = None) -> DataFrame:
    """Adds the counts that rules refer to, and drops the text."""
    stop = stop_words or STOP_WORDS
    own = ["n_words", "word_chars", "n_symbols", "n_exclamations", "n_stop_words", "n_lines", "n_dup_lines", "n_repeat_words"]
    inner, held = sheltered(docs)
    names = [c for c in docs.columns if c != text and c not in own]
    kept = [held[c] for c in names]
    t = F.coalesce(F.col(held[text]), F.lit(""))
    words = F.array_remove(F.split(F.translate(t, SPACES, " " * len(SPACES)), " "), "")
    lines = F.filter(F.split(t, "\n"), lambda x: F.length(without(x, SPACES)) > 0)
    first = inner.select(
        *kept,
        words.alias("__words"),
        lines.alias("__lines"),
        F.length(without(t, SPACES)).cast("long").alias("word_chars"),
        (F.length(t) - F.length(without(t, SYMBOLS))).cast("long").alias("n_symbols"),
        (F.length(t) - F.length(without(t, "!"))).cast("long").alias("n_exclamations"),
    )
    w = F.col("__words")
    second = first.select(
        *kept,
        "word_chars",
        "n_symbols",
        "n_exclamations",
        F.size(w).cast("long").alias("n_words"),
        F.size(F.filter(w, lambda x: F.lower(F.rtrim(x, F.lit(",.!?;:"))).isin(stop))).cast("long").alias("n_stop_words"),
        F.size("__lines").cast("long").alias("n_lines"),
        (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long").alias("n_dup_lines"),
        F.transform(w, lambda x: F.xxhash64(x)).alias("__hash"),
    )
    h = F.col("__hash")
    starts = F.sequence(F.lit(0), F.size(h) - 3)
    window = lambda i: F.struct(F.xxhash64(F.get(h, i), F.get(h, i + 1), F.get(h, i + 2)).alias("h"), i.alias("i"))
    third = second.select(*kept, *own[:7], F.when(F.size(h) >= 3, F.sort_array(F.transform(starts, window))).otherwise(F.array().cast("array<struct<h:bigint,i:int>>")).alias("__windows"))
    s = F.col("__windows")
    # A window is repeated if its neighbour in hash order has the same hash; their starts, in text order.
    same = lambda x, k: (F.get(s, k - 1)["h"] == x["h"]) | (F.get(s, k + 1)["h"] == x["h"])
    fourth = third.select(*kept, *own[:7], F.sort_array(F.transform(F.filter(s, lambda x, k: F.coalesce(same(x, k), F.lit(False))), lambda x: x["i"])).alias("__starts"))
    p = F.col("__starts")
    covered = F.transform(p, lambda x, k: F.least(F.lit(3), F.coalesce(F.get(p, k + 1), x + 3) - x))
    return fourth.select(*[F.col(held[c]).alias(c) for c in names], *own[:7], F.aggregate(covered, F.lit(0), lambda a, x: a + x).cast("long").alias("n_repeat_words"))


def verdict(rules=RULES) -> Column:
    """The table as one expression."""
    passed = F.lit(True)
    for r in rules:
        ratio = F.col(r.numerator) / F.nullif(F.col(r.denominator), F.lit(0))
        if r.low is not None:
            passed = passed & F.coalesce(ratio >= r.low, F.lit(True))
        if r.high is not None:
            passed = passed & F.coalesce(ratio <= r.high, F.lit(True))
    return passed


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def quality_rules(docs: DataFrame, text: str = "text", rules=RULES) -> DataFrame:
    """Counts, ``base_failed`` and ``kept`` for every row."""
    return quality_counts(docs, text).withColumns({"base_failed": base_failed(), "kept": ~base_failed() & verdict(rules)})


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    return quality_rules(read_documents(spark, sf_dir, "text")).select(*columns)


def oracle() -> str:
    """The same in DuckDB's SQL, by joins of words instead of arrays."""
    stop = ", ".join(f"'{w}'" for w in STOP_WORDS)
    space = r"[^\x20\x09-\x0D]"
    return rf"""
with t as (select row_number() over () r, doc_id, coalesce(text, '') as text from documents),
w as (select r, unnest(ws) as word, generate_subscripts(ws, 1) as i from (select r, regexp_extract_all(text, '{space}+') ws from t)),
win as (select r, i, word || ' ' || lead(word) over o || ' ' || lead(word, 2) over o as g from w window o as (partition by r order by i)),
rep as (select r, i from (select r, i, count(*) over (partition by r, g) n from win where g is not null) where n > 1),
cov as (select r, count(distinct i + k) n from rep, (values (0), (1), (2)) v(k) group by r),
ws as (select r, count(*) n_words, sum(length(word)) word_chars, count_if(lower(rtrim(word, ',.!?;:')) in ({stop})) n_stop from w group by r),
l as (select r, count(*) n_lines, count(*) - count(distinct line) n_dup from (select r, unnest(string_split(text, chr(10))) line from t) where regexp_matches(line, '{space}') group by r),
c as (select doc_id, coalesce(n_words, 0) n_words, coalesce(word_chars, 0) word_chars, length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) n_symbols,
  length(regexp_replace(text, '[^!]', '', 'g')) n_excl, coalesce(n_stop, 0) n_stop, coalesce(n_lines, 0) n_lines, coalesce(n_dup, 0) n_dup_lines, coalesce(cov.n, 0) n_repeat_words
  from t left join ws using (r) left join l using (r) left join cov using (r)),
b as (select *, n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed from c)
select doc_id, n_words::bigint n_words, word_chars::bigint word_chars, n_symbols::bigint n_symbols, n_dup_lines::bigint n_dup_lines, n_repeat_words::bigint n_repeat_words, base_failed,
  not base_failed and word_chars / n_words between 2.0 and 15.0 and n_symbols / n_words <= 0.1 and n_excl / n_words <= 0.3
  and n_stop / n_words >= 0.05 and n_dup_lines / n_lines <= 0.3 as kept from b"""
