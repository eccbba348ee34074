"""Review text statistics.

Input rows are (comment, category, aspect, sentiment) judgements:
``rid`` (comment id, repeats across judgements), ``review`` (text),
``category``, ``aspect`` and ``sentiment``.

Counts use ``count("rid")``: rows whose comment id is null are not counted,
but their group still appears (with 0).
"""

from __future__ import annotations

from collections.abc import Collection, Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from revlens.functions.text import DEFAULT_TOKEN_DELIMITERS, delimiter_class, has_visible_char
from revlens.operators.topk import top_k_per_group, top_one


def normalize(reviews: DataFrame) -> DataFrame:
    """Lower-case text and sentiment, upper-case category and aspect."""
    cols = [F.col("rid"), F.lower("review").alias("review_lc")]
    names = set(reviews.columns)
    for name, fn in (("category", F.upper), ("aspect", F.upper), ("sentiment", F.lower)):
        if name in names:
            cols.append(fn(name).alias(name))
    return reviews.select(*cols)


def tokens(normalized: DataFrame, delimiters: str = DEFAULT_TOKEN_DELIMITERS) -> DataFrame:
    """One row per non-blank token, carrying the judgement's other columns.

    The raw split may yield empty strings (a leading delimiter); the blank
    filter after the explode drops them, so no per-document array copy is
    made to remove them first.
    """
    keep = [c for c in normalized.columns if c != "review_lc"]
    parts = F.split("review_lc", delimiter_class(delimiters), -1)
    exploded = normalized.select(*keep, F.explode(parts).alias("word"))
    return exploded.where(has_visible_char("word"))


def stop_word_table(spark: SparkSession, words: Iterable[str]) -> DataFrame:
    """A one-column ``word`` table from an in-code list, built on the JVM side."""
    lits = [F.lit(w) for w in words]
    arr = F.array(*lits) if lits else F.array().cast("array<string>")
    return spark.range(1).select(F.explode(arr).alias("word"))


StopWords = DataFrame | Collection[str]


def remove_stop_words(toks: DataFrame, stop_words: StopWords) -> DataFrame:
    """Drop tokens equal to a stop word (exact, case-sensitive; repeats harmless).

    A stop table is anti-joined on ``word``; the optimizer's size checks pick
    the join.  An in-code list becomes a hash-set membership filter
    inside the scan stage: no exchange at all.
    """
    if isinstance(stop_words, DataFrame):
        return toks.join(stop_words.select("word"), "word", "left_anti")
    words = sorted({w for w in stop_words if w is not None})
    if not words:
        return toks
    return toks.where(~F.col("word").isin(words))


def clean_words(reviews: DataFrame, stop_words: StopWords,
                delimiters: str = DEFAULT_TOKEN_DELIMITERS) -> DataFrame:
    """``rid, category, aspect, sentiment, word`` after stop-word removal."""
    words = remove_stop_words(tokens(normalize(reviews), delimiters), stop_words)
    cols = [c for c in ("rid", "category", "aspect", "sentiment") if c in words.columns]
    return words.select(*cols, "word")


def word_freq_over(words: DataFrame, threshold: int = 500) -> DataFrame:
    """``word, freq`` for words counted strictly more than ``threshold`` times."""
    freq = words.groupBy("word").agg(F.count("rid").alias("freq"))
    return freq.where(F.col("freq") > threshold)


def comment_counts(raw: DataFrame, key: str) -> DataFrame:
    """``key, total_rows, distinct_comments`` on the raw (un-normalised) key."""
    return raw.groupBy(key).agg(
        F.count("rid").alias("total_rows"),
        F.countDistinct("rid").alias("distinct_comments"))


def aspect_counts(normalized: DataFrame, sentiment: str, count_name: str) -> DataFrame:
    """``aspect, <count_name>``: judgements per aspect for one sentiment."""
    rows = normalized.where(F.col("sentiment") == sentiment)
    return rows.groupBy("aspect").agg(F.count("rid").alias(count_name))


def most_judged_aspect(reviews: DataFrame, sentiment: str, count_name: str) -> DataFrame:
    """The aspect with most ``sentiment`` judgements; ties go to the smaller name.

    A missing (null) aspect counts as the smallest name.
    """
    counts = aspect_counts(normalize(reviews), sentiment, count_name)
    return top_one(counts, [F.desc(count_name), F.asc_nulls_first("aspect")])


def word_counts(words: DataFrame, keys: Iterable[str]) -> DataFrame:
    """``keys..., word, cnt``."""
    keys = list(keys)
    return words.groupBy(*keys, "word").agg(F.count("rid").alias("cnt"))


def top_words(counts: DataFrame, k: int = 5, sentiment: str | None = None) -> DataFrame:
    """``category, word, cnt``: the ``k`` most counted words per category.

    Order is count descending, then word ascending (binary UTF-8 order).
    """
    if sentiment is not None:
        counts = counts.where(F.col("sentiment") == sentiment)
    top = top_k_per_group(counts, ["category"], [F.desc("cnt"), F.asc("word")], k)
    return top.select("category", "word", "cnt")
