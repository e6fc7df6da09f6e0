"""Quality rules: a threshold table compiled into one projection of built-in expressions."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripfold.functions.scalars import computed_once

SPACE = r"[\x20\x09-\x0D]+"  # fixed value: what parts words
SYMBOLS = "[#*$%&|<>]"  # fixed value: what counts as a symbol
MIN_WORDS = 50  # fixed values of the base rule
MAX_REPEATED = 50  # per cent of the words

#: Very frequent words of the corpus' languages, in lower case.
STOP_WORDS = (
    "the", "of", "and", "to", "a", "in", "is", "that", "it", "for", "was", "with", "be", "by", "on", "are", "this", "from",
    "de", "la", "le", "les", "des", "et", "un", "une", "du", "en", "que", "qui", "dans", "est", "pour", "par", "sur",
    "der", "die", "das", "und", "den", "von", "zu", "mit", "ist", "nicht", "ein", "eine", "auf", "dem", "als",
    "el", "los", "las", "se", "con", "no", "una", "su", "para", "al", "lo", "como", "y",
)


@dataclass(frozen=True)
class Rule:
    """A document fails if the metric lies outside low..high, bounds included."""

    name: str
    metric: str  # SQL over the columns of `measured`
    low: float | None = None
    high: float | None = None


#: The production table.
RULES = (
    Rule("word_length", "word_chars / nullif(n_words, 0)", 2, 15),
    Rule("symbols", "n_symbols / nullif(n_words, 0)", None, 0.25),
    Rule("stop_words", "n_stop_words / nullif(n_words, 0)", 0.02, None),
    Rule("repeated_lines", "n_dup_lines / nullif(n_lines, 0)", None, 0.6),
    Rule("line_words", "n_words / nullif(n_lines, 0)", 2, None),
    Rule("bullet_lines", "n_bullet_lines / nullif(n_lines, 0)", None, 0.9),
    Rule("open_lines", "n_open_lines / nullif(n_lines, 0)", None, 0.5),
)


def _bound(value: Column, body) -> Column:
    """body(value) with the value computed once, whatever number of times the body names it."""
    return F.transform(F.array(value), body)[0]


def _covered(windows: Column) -> Column:
    """Words that lie in a three-word window found more than once, from the windows' hashes in text order."""

    def repeated(pairs: Column) -> Column:
        last = F.size(pairs) - 1
        same = lambda x, k: F.when(k < 0, False).when(k > last, False).otherwise(F.get(pairs, k)["h"] == x["h"])
        return F.array_sort(F.transform(F.filter(pairs, lambda x, k: same(x, k - 1) | same(x, k + 1)), lambda x: x["i"]))

    def add(done: Column, i: Column) -> Column:
        return F.struct(i.alias("last"), (done["n"] + F.least(F.lit(3), i - done["last"])).alias("n"))

    pairs = F.array_sort(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    start = F.struct(F.lit(-3).alias("last"), F.lit(0).alias("n"))
    covered = _bound(pairs, lambda p: F.aggregate(repeated(p), start, add, lambda done: done["n"]))
    return F.when(F.size(F.array_distinct(windows)) == F.size(windows), 0).otherwise(covered)


def measured(docs: DataFrame) -> DataFrame:
    """doc_id and the counts that rules are written over.

    n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines (lines with
    a word), n_stop_words, n_bullet_lines, n_open_lines (ending in an ellipsis).
    One narrow projection: no shuffle, no user function.
    """
    text = F.coalesce("text", F.lit(""))
    parts = docs.select(
        F.col("doc_id"),
        (F.size(F.split(text, SYMBOLS, -1)) - 1).alias("n_symbols"),
        F.array_remove(F.split(text, SPACE), "").alias("words"),
        F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")).alias("lines"),
    )
    words, n = F.col("words"), F.size("words")
    window = lambda i: F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2))
    windows = F.when(n >= 3, F.transform(F.sequence(F.lit(0), n - 3), window)).otherwise(F.array().cast("array<long>"))
    lines = lambda test: F.size(F.filter("lines", test))
    counts = {
        "n_words": n,
        "word_chars": F.length(F.array_join("words", "")),
        "n_symbols": F.col("n_symbols"),
        "n_dup_lines": F.size("lines") - F.size(F.array_distinct("lines")),
        "n_repeat_words": _bound(windows, _covered),
        "n_lines": F.size("lines"),
        "n_stop_words": F.size(F.filter(words, lambda w: w.isin(*STOP_WORDS))),
        "n_bullet_lines": lines(lambda x: x.rlike(r"^[\x20\x09-\x0D]*[-*•]")),
        "n_open_lines": lines(lambda x: x.rlike(r"(\.\.\.|…)[\x20\x09-\x0D]*$")),
    }
    return parts.select("doc_id", *(c.cast("long").alias(name) for name, c in counts.items()))


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATED * F.col("n_words"))


def passes(rules: tuple[Rule, ...]) -> Column:
    """The table as one boolean expression. A ratio over nothing (null) fails no rule."""
    tests = [F.lit(True)]
    for rule in rules:
        value = F.expr(rule.metric)
        tests += [F.coalesce(value >= rule.low, F.lit(True))] if rule.low is not None else []
        tests += [F.coalesce(value <= rule.high, F.lit(True))] if rule.high is not None else []
    out = tests[0]
    for test in tests[1:]:
        out = out & test
    return out


def judge(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept of every text.

    Null text has no words, and so fails the base rule like empty text and texts of
    white space. Rows stay as they are, repeated and null ids too; an empty table
    gives no rows; other columns are ignored. Work is linear in a text's length, but for the
    sort of its word windows where one repeats; a filter on the result stays above the counts.
    """
    counts = computed_once(measured(docs.select(F.col("doc_id").cast("long"), "text")))
    return counts.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        base_failed().alias("base_failed"),
        (~base_failed() & passes(rules)).alias("kept"),
    )


def keep_good(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The rows that pass, with all their columns as they came; nothing is moved.

    Rows with null, empty or wordless text fail the base rule; an empty table gives no rows.
    """
    whole = docs.select(F.struct("*").alias("doc_id"), "text")  # the row travels in place of its id
    return computed_once(measured(whole)).where(~base_failed() & passes(rules)).select("doc_id.*")
