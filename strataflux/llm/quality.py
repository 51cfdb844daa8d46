"""Quality rules as a short-circuit cascade, with Spark's own functions only.

The cost of each rule, with the features it needs computed from the raw text, and the share of rows it rejects are
measured on a bounded sample; rules then run by rejection per cost, so that most bad rows leave at a cheap rule. A rule's
features are computed for the rows that no rule before it has rejected: for others its text is null. The
order changes the work, never the verdict, since a row is kept if no rule rejects it.

Null text has no words: all counts are 0. Null ids pass through. Other columns are kept
beside the new ones; columns with the names of features, ``rejected_by`` and ``passed`` are replaced, and so are those named like
the intermediate columns (``_words``, ``_hashes``, ``_windows``, ``_sorted``, ``_starts``, ``_lines``, ``_alive``).
"""

from __future__ import annotations

import time
from collections.abc import Collection
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, functions as F

#: Rows, at most, on which costs and rejections are measured, and how often each rule is timed.
SAMPLE_ROWS, TIMES = 1024, 2
#: Words in a window that counts as repeated when it occurs twice.
WINDOW = 5
FEATURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


@dataclass(frozen=True)
class Rule:
    """``rejects``, on the features that it ``needs``, is true for rows to drop; null counts as false."""

    name: str
    rejects: Column
    needs: tuple[str, ...] = FEATURES


def features(docs: DataFrame, text_col: str = "text", names: Collection[str] = FEATURES) -> DataFrame:
    """Add those of n_words, word_chars, n_symbols, n_dup_lines and n_repeat_words (long) that are named.

    Arrays are built in columns of their own: a lambda that refers to a column reads it, while
    one that refers to an expression would build it again for each element.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    out, counts = docs, {}
    if "n_words" in names or "n_repeat_words" in names:
        out = out.withColumn("_words", F.array_remove(F.split(F.translate(text, "\t\n\x0b\f\r", "     "), " "), ""))
    if "n_words" in names:
        counts["n_words"] = F.size("_words")
    if "word_chars" in names:
        counts["word_chars"] = F.length(F.translate(text, " \t\n\x0b\f\r", ""))
    if "n_symbols" in names:
        counts["n_symbols"] = F.length(text) - F.length(F.translate(text, "#*$%&|<>", ""))
    if "n_dup_lines" in names:
        out = out.withColumn("_lines", F.filter(F.split(text, "\n"), lambda x: F.length(F.translate(x, " \t\x0b\f\r", "")) > 0))
        counts["n_dup_lines"] = F.size("_lines") - F.size(F.array_distinct("_lines"))
    if "n_repeat_words" in names:
        out = out.withColumn("_hashes", F.transform("_words", lambda w: F.xxhash64(w)))
        after = lambda i, k: F.get(F.col("_hashes"), i + k)
        window = lambda h, i: F.struct(F.xxhash64(h, *(after(i, k) for k in range(1, WINDOW))).alias("h"), i.alias("i"))
        out = out.withColumn("_windows", F.when(F.size("_hashes") >= WINDOW, F.slice(F.transform("_hashes", window), F.lit(1), F.size("_hashes") - (WINDOW - 1))))
        # Most texts repeat no window: only the others are sorted.
        out = out.withColumn("_sorted", F.when(F.size(F.array_distinct("_windows.h")) < F.size("_windows"), F.array_sort("_windows")))
        twice = lambda w, k: F.when((F.get(F.col("_sorted"), k - 1)["h"] == w["h"]) | (F.get(F.col("_sorted"), k + 1)["h"] == w["h"]), w["i"])
        out = out.withColumn("_starts", F.array_sort(F.filter(F.transform("_sorted", twice), lambda i: i.isNotNull())))
        steps = F.transform("_starts", lambda p, k: F.least(F.coalesce(F.get(F.col("_starts"), k + 1) - p, F.lit(WINDOW)), F.lit(WINDOW)))
        counts["n_repeat_words"] = F.coalesce(F.aggregate(steps, F.lit(0), lambda a, x: a + x), F.lit(0))
    return out.withColumns({k: c.cast("long") for k, c in counts.items()}).drop("_words", "_hashes", "_windows", "_sorted", "_starts", "_lines")


def default_rules() -> list[Rule]:
    """Rules on the counts of :func:`features`, in integers so that no rounding decides."""
    return [
        Rule("symbols", F.col("n_symbols") * 10 > F.col("n_words") * 3, ("n_symbols", "n_words")),
        Rule("duplicate_lines", F.col("n_dup_lines") * 100 > F.col("n_words") * 5, ("n_dup_lines", "n_words")),
        Rule("short_words", F.col("word_chars") < F.col("n_words") * 2, ("word_chars", "n_words")),
        Rule("long_words", F.col("word_chars") > F.col("n_words") * 15, ("word_chars", "n_words")),
    ]


def order_rules(docs: DataFrame, rules: list[Rule], text_col: str = "text", sample_rows: int = SAMPLE_ROWS) -> list[tuple[Rule, float, float]]:
    """(rule, seconds, share rejected), best rejection per cost first; ties keep the given order.

    The sample is drawn from the whole table and holds raw text alone. A rule's cost is the least of a few runs that compute its features
    from that text, less the least time of runs that only count the rows.
    """
    n = docs.count()
    texts = docs.select(text_col)
    drawn = texts if n <= sample_rows else texts.sample(min(1.0, 1.2 * sample_rows / n), seed=7).limit(sample_rows)
    sample = drawn.persist(StorageLevel.MEMORY_AND_DISK)

    def timed(df: DataFrame, rejects: Column) -> tuple[float, int]:
        taken = []
        for _ in range(TIMES):
            began = time.perf_counter()
            rejected = df.agg(F.count_if(F.coalesce(rejects, F.lit(False)))).head()[0]
            taken.append(time.perf_counter() - began)
        return min(taken), rejected

    try:
        rows = max(sample.count(), 1)
        timed(sample, F.length(text_col) < 0)
        bare, _ = timed(sample, F.length(text_col) < 0)
        found = []
        for rule in rules:
            seconds, rejected = timed(features(sample, text_col, rule.needs), rule.rejects)
            found.append((rule, max(seconds - bare, 1e-4), rejected / rows))
        return sorted(found, key=lambda x: -x[2] / x[1])
    finally:
        sample.unpersist()


def cascade(docs: DataFrame, rules: list[Rule], text_col: str = "text", sample_rows: int = SAMPLE_ROWS, given: Collection[str] = ()) -> DataFrame:
    """Add ``rejected_by`` (the first rule, in the order found, that rejects the row; null if none) and ``passed``.

    Features that ``docs`` has already (``given``) are read; others are computed for the rows still alive when a rule first needs
    them, and dropped at the end.
    """
    have, out = set(given), docs.withColumn("rejected_by", F.lit(None).cast("string"))
    for rule, _, _ in order_rules(docs, rules, text_col, sample_rows):
        missing = [k for k in rule.needs if k not in have]
        if missing:
            out = features(out.withColumn("_alive", F.when(F.col("rejected_by").isNull(), F.col(text_col))), "_alive", missing).drop("_alive")
            have.update(missing)
        out = out.withColumn("rejected_by", F.when(F.col("rejected_by").isNotNull(), F.col("rejected_by")).when(rule.rejects, F.lit(rule.name)))
    return out.drop(*(have - set(given))).withColumn("passed", F.col("rejected_by").isNull())


def base_failed() -> Column:
    return (F.col("n_words") < 10) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 20)
