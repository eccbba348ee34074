"""Named queries over the driver tables, each with an equivalent DuckDB SQL.

``queries()[name](spark, sf_dir)`` returns a lazy DataFrame; ``oracle_sql()[name]``
computes the same rows in DuckDB over views named after the parquet tables.
Averages are rounded to 6 places on both sides so value hashes compare.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from revlens.functions import fmt
from revlens.operators import ratings as R
from revlens.operators import reviews as V
from revlens.operators.joins import lookup_with_fallback
from revlens.plans import bindings as B
from revlens.plans import text_files
from revlens.plans.report import item_report_lines
from revlens.sources import parse_items, parse_ratings, parse_reviews, parse_users

Query = Callable[[SparkSession, str], DataFrame]
DIGITS = 6


def _round(df: DataFrame, *cols: str) -> DataFrame:
    """Round ``cols`` to ``DIGITS`` places in one projection."""
    return df.select(*[F.round(c, DIGITS).alias(c) if c in cols else F.col(c)
                       for c in df.columns])


# ---------------------------------------------------------------- ratings

def q_ratings_union(spark: SparkSession, d: str) -> DataFrame:
    return B.ratings_with_user(spark, d)


def q_rating_avg_by_item(spark: SparkSession, d: str) -> DataFrame:
    return _round(R.rating_avg_by_item(B.ratings(spark, d), B.items(spark, d)), "avg_rating")


def q_top_rated_item(spark: SparkSession, d: str) -> DataFrame:
    best = R.best_rated_item(B.ratings(spark, d), B.items(spark, d), B.TOP_ITEM_MIN_COUNT)
    return _round(best, "avg_rating")


def _item_genres(spark: SparkSession, d: str) -> DataFrame:
    return R.explode_genres(B.items(spark, d), B.ITEM_GENRE_SEPARATOR)


def q_genre_rating_pairs(spark: SparkSession, d: str) -> DataFrame:
    return R.genre_rating_pairs(B.ratings(spark, d), _item_genres(spark, d))


def q_rating_avg_by_genre(spark: SparkSession, d: str) -> DataFrame:
    return _round(R.rating_avg_by_genre(B.ratings(spark, d), _item_genres(spark, d)),
                  "avg_rating")


def q_rating_avg_by_gender(spark: SparkSession, d: str) -> DataFrame:
    rated = B.rated_by_known_users(spark, d, "gender_side")
    return _round(R.gender_averages_titled(rated, B.items(spark, d)), "male_avg", "female_avg")


def q_rating_avg_by_age_group(spark: SparkSession, d: str) -> DataFrame:
    rated = B.rated_by_known_users(spark, d, "age_group")
    cols = [name for _, name in R.age_group_names(B.AGE_BOUNDS)]
    return _round(R.age_group_averages_titled(rated, B.items(spark, d), B.AGE_BOUNDS), *cols)


# ------------------------------------------------- ratings as output lines

def q_item_report_lines(spark: SparkSession, d: str) -> DataFrame:
    return item_report_lines(R.item_stats(B.ratings(spark, d)), B.items(spark, d), B.TOP_ITEM_MIN_COUNT)


def q_genre_report_lines(spark: SparkSession, d: str) -> DataFrame:
    by_genre = R.rating_avg_by_genre(B.ratings(spark, d), _item_genres(spark, d))
    return by_genre.select(F.col("genre").alias("key"),
                           fmt.item_line("avg_rating", "n_ratings").alias("value"))


def q_gender_report_lines(spark: SparkSession, d: str) -> DataFrame:
    rated = B.rated_by_known_users(spark, d, "gender_side")
    return R.gender_averages_titled(rated, B.items(spark, d)).select(
        F.col("title").alias("key"), fmt.gender_line("male_avg", "female_avg").alias("value"))


def q_age_group_report_lines(spark: SparkSession, d: str) -> DataFrame:
    rated = B.rated_by_known_users(spark, d, "age_group")
    groups = R.age_group_names(B.AGE_BOUNDS)
    return R.age_group_averages_titled(rated, B.items(spark, d), B.AGE_BOUNDS).select(
        F.col("title").alias("key"),
        fmt.bucket_line([g for g, _ in groups], [c for _, c in groups]).alias("value"))


# ---------------------------------------------------------------- reviews

def _words(spark: SparkSession, d: str, with_sentiment: bool) -> DataFrame:
    return V.clean_words(B.reviews(spark, d, with_sentiment), B.STOP_WORDS,
                         B.TOKEN_DELIMITERS)


def q_clean_words(spark: SparkSession, d: str) -> DataFrame:
    return _words(spark, d, True)


def q_word_freq_over(spark: SparkSession, d: str) -> DataFrame:
    return V.word_freq_over(_words(spark, d, False), B.WORD_FREQ_THRESHOLD)


def q_count_by_category(spark: SparkSession, d: str) -> DataFrame:
    return V.comment_counts(B.reviews(spark, d, with_sentiment=False), "category")


def q_count_by_aspect(spark: SparkSession, d: str) -> DataFrame:
    return V.comment_counts(B.conversation_judgements(spark, d), "aspect")


def q_most_negative_aspect(spark: SparkSession, d: str) -> DataFrame:
    return V.most_judged_aspect(B.reviews(spark, d), "negative", "neg_count")


def q_most_positive_aspect(spark: SparkSession, d: str) -> DataFrame:
    return V.most_judged_aspect(B.reviews(spark, d), "positive", "pos_count")


def q_word_count_by_category_sentiment(spark: SparkSession, d: str) -> DataFrame:
    return V.word_counts(_words(spark, d, True), ["category", "sentiment"])


def q_word_count_by_category(spark: SparkSession, d: str) -> DataFrame:
    return V.word_counts(_words(spark, d, False), ["category"])


def q_top5_positive_words(spark: SparkSession, d: str) -> DataFrame:
    counts = V.word_counts(_words(spark, d, True), ["category", "sentiment"])
    return V.top_words(counts, B.TOP_K, "positive")


def q_top5_negative_words(spark: SparkSession, d: str) -> DataFrame:
    counts = V.word_counts(_words(spark, d, True), ["category", "sentiment"])
    return V.top_words(counts, B.TOP_K, "negative")


def q_top5_related_words(spark: SparkSession, d: str) -> DataFrame:
    counts = V.word_counts(_words(spark, d, False), ["category"])
    return V.top_words(counts, B.TOP_K)


def q_clean_words_stop_table(spark: SparkSession, d: str) -> DataFrame:
    return V.clean_words(B.reviews(spark, d), B.benchmark_words(spark, d), B.TOKEN_DELIMITERS)


def q_word_freq_stop_table(spark: SparkSession, d: str) -> DataFrame:
    words = V.clean_words(B.reviews(spark, d, False), B.benchmark_words(spark, d), B.TOKEN_DELIMITERS)
    return V.word_freq_over(words, 0)


def q_document_words_labelled(spark: SparkSession, d: str) -> DataFrame:
    """Words per document with its quality label, or its id where there is no label."""
    totals = _words(spark, d, False).groupBy(F.col("rid").alias("doc_id")).agg(F.count("word").alias("n_words"))
    label = B.table(spark, d, "labels").select("doc_id", F.concat(F.lit("quality "), F.col("quality").cast("string")).alias("label"))
    return lookup_with_fallback(totals, label, "doc_id", "label").select("doc_id", "n_words", "label")


# ----------------------------------------------------- tables from text lines

def q_ratings_from_lines(spark: SparkSession, d: str) -> DataFrame:
    return parse_ratings(B.rating_lines(spark, d))


def q_items_from_lines(spark: SparkSession, d: str) -> DataFrame:
    return parse_items(B.item_lines(spark, d))


def q_users_from_lines(spark: SparkSession, d: str) -> DataFrame:
    return parse_users(B.user_lines(spark, d))


def q_reviews_from_lines(spark: SparkSession, d: str) -> DataFrame:
    return parse_reviews(B.review_lines(spark, d))


def queries() -> dict[str, Query]:
    return {
        "ratings_union": q_ratings_union,
        "rating_avg_by_item": q_rating_avg_by_item,
        "top_rated_item": q_top_rated_item,
        "genre_rating_pairs": q_genre_rating_pairs,
        "rating_avg_by_genre": q_rating_avg_by_genre,
        "rating_avg_by_gender": q_rating_avg_by_gender,
        "rating_avg_by_age_group": q_rating_avg_by_age_group,
        "item_report_lines": q_item_report_lines,
        "genre_report_lines": q_genre_report_lines,
        "gender_report_lines": q_gender_report_lines,
        "age_group_report_lines": q_age_group_report_lines,
        "clean_words": q_clean_words,
        "word_freq_over": q_word_freq_over,
        "count_by_category": q_count_by_category,
        "count_by_aspect": q_count_by_aspect,
        "most_negative_aspect": q_most_negative_aspect,
        "most_positive_aspect": q_most_positive_aspect,
        "word_count_by_category_sentiment": q_word_count_by_category_sentiment,
        "word_count_by_category": q_word_count_by_category,
        "top5_positive_words": q_top5_positive_words,
        "top5_negative_words": q_top5_negative_words,
        "top5_related_words": q_top5_related_words,
        "clean_words_stop_table": q_clean_words_stop_table,
        "word_freq_stop_table": q_word_freq_stop_table,
        "document_words_labelled": q_document_words_labelled,
        "ratings_from_lines": q_ratings_from_lines,
        "items_from_lines": q_items_from_lines,
        "users_from_lines": q_users_from_lines,
        "reviews_from_lines": q_reviews_from_lines,
    } | text_files.queries()


# ---------------------------------------------------------------- oracle SQL

_HALVES = ", ".join(f"'{h}'" for h in B.RATING_HALVES)
_RATINGS = (f"SELECT l_partkey AS item_id, l_quantity AS rating, l_orderkey AS order_key "
            f"FROM lineitem")
_TITLES = "SELECT p_partkey AS item_id, max(p_name) AS title FROM part GROUP BY p_partkey"
_PER_ITEM = f"""
  r AS ({_RATINGS}),
  a AS (SELECT item_id, avg(rating) AS avg_rating, count(rating) AS n_ratings
        FROM r GROUP BY item_id),
  t AS ({_TITLES}),
  it AS (SELECT a.item_id, coalesce(t.title, CAST(a.item_id AS VARCHAR)) AS title,
                a.avg_rating, a.n_ratings
         FROM a LEFT JOIN t ON a.item_id = t.item_id)"""
_GENRE_PAIRS = f"""
  r AS ({_RATINGS}),
  g AS (SELECT item_id, genre FROM
          (SELECT p_partkey AS item_id,
                  unnest(string_split(p_name, '{B.ITEM_GENRE_SEPARATOR}')) AS genre FROM part)),
  pairs AS (SELECT g.genre, r.rating FROM r JOIN g ON r.item_id = g.item_id)"""
_USERS = f"""
  u AS (SELECT DISTINCT c_custkey AS user_id,
               CASE c_mktsegment WHEN '{B.MALE_SEGMENT}' THEN 'M'
                                 WHEN '{B.FEMALE_SEGMENT}' THEN 'F'
                                 ELSE c_mktsegment END AS gender,
               c_acctbal AS age
        FROM customer),
  r AS ({_RATINGS}),
  ru AS (SELECT r.item_id, r.rating, u.gender, u.age
         FROM r JOIN orders o ON r.order_key = o.o_orderkey
                JOIN u ON o.o_custkey = u.user_id),
  t AS ({_TITLES})"""


def _age_sql() -> str:
    names = R.age_group_names(B.AGE_BOUNDS)
    parts = []
    for i, (_, name) in enumerate(names):
        cond = f"age >= {B.AGE_BOUNDS[i]}"
        if i + 1 < len(B.AGE_BOUNDS):
            cond += f" AND age < {B.AGE_BOUNDS[i + 1]}"
        parts.append((name, f"avg(CASE WHEN {cond} THEN rating END) AS {name}"))
    aggs = ",\n       ".join(p for _, p in parts)
    outs = ", ".join(f"round(s.{n}, {DIGITS}) AS {n}" for n, _ in parts)
    return f"""WITH {_USERS},
  s AS (SELECT item_id,
       {aggs}
        FROM ru GROUP BY item_id)
SELECT s.item_id, coalesce(t.title, CAST(s.item_id AS VARCHAR)) AS title, {outs}
FROM s LEFT JOIN t ON s.item_id = t.item_id"""


def _fmt2(x: str) -> str:
    """Java's ``%.2f``: half-up rounding of the shortest decimal form of a double."""
    return f"printf('%.2f', round(CAST(CAST({x} AS VARCHAR) AS DECIMAL(38, 18)), 2))"


def _item_lines_sql(ordered: bool = False) -> str:
    order = (", 0 AS top, item_id::VARCHAR AS id", ", 1 AS top, NULL AS id") if ordered else ("", "")
    no_top = fmt.NO_TOP_ITEM_LINE % B.TOP_ITEM_MIN_COUNT
    return f"""WITH {_PER_ITEM},
  best AS (SELECT * FROM it
           WHERE n_ratings >= {B.TOP_ITEM_MIN_COUNT} AND NOT isnan(avg_rating)
           ORDER BY avg_rating DESC, CAST(item_id AS VARCHAR) ASC NULLS FIRST LIMIT 1)
SELECT title AS key, {_fmt2('avg_rating')} || ' (TotalRatings: ' || n_ratings || ')' AS value{order[0]}
FROM it
UNION ALL
SELECT '{fmt.TOP_ITEM_KEY}' AS key,
       CASE WHEN best.item_id IS NULL THEN '{no_top}'
            ELSE best.title || ' (Average: ' || {_fmt2('best.avg_rating')} || ')' END AS value{order[1]}
FROM (SELECT 1 AS one) d LEFT JOIN best ON TRUE"""


def _age_lines_sql() -> str:
    names = R.age_group_names(B.AGE_BOUNDS)
    parts = []
    for i, (_, name) in enumerate(names):
        cond = f"age >= {B.AGE_BOUNDS[i]}"
        if i + 1 < len(B.AGE_BOUNDS):
            cond += f" AND age < {B.AGE_BOUNDS[i + 1]}"
        parts.append(f"coalesce(avg(CASE WHEN {cond} THEN rating END), 0.0) AS {name}")
    aggs = ",\n       ".join(parts)
    text = " || ', ' || ".join(f"'{label}: ' || {_fmt2('s.' + name)}" for label, name in names)
    return f"""WITH {_USERS},
  s AS (SELECT item_id,
       {aggs}
        FROM ru GROUP BY item_id)
SELECT coalesce(t.title, CAST(s.item_id AS VARCHAR)) AS key, '[' || {text} || ']' AS value
FROM s LEFT JOIN t ON s.item_id = t.item_id"""


_DELIMS = "[ \\t\\n\\x0B\\f\\r\",()*]+"
_STOPS = ", ".join("'" + w.replace("'", "''") + "'" for w in B.STOP_WORDS)
_REVIEWS = """
  rv AS (SELECT d.doc_id AS rid, d.text AS review, d.source AS category, d.lang AS aspect,
                CASE WHEN l.toxic = 1 THEN 'negative'
                     WHEN l.quality = 1 THEN 'positive'
                     WHEN l.doc_id IS NOT NULL THEN 'neutral'
                     ELSE 'unlabelled' END AS sentiment
         FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)"""
_WORDS = f"""{_REVIEWS},
  tok AS (SELECT rid, upper(category) AS category, upper(aspect) AS aspect,
                 lower(sentiment) AS sentiment,
                 unnest(string_split_regex(lower(review), '{_DELIMS}')) AS word
          FROM rv),
  words AS (SELECT rid, category, aspect, sentiment, word FROM tok
            WHERE word <> '' AND regexp_matches(word, '[^\\x00-\\x20]')
              AND word NOT IN ({_STOPS}))"""


def _top_words_sql(where: str) -> str:
    return f"""WITH {_WORDS},
  c AS (SELECT category, word, count(rid) AS cnt FROM words {where} GROUP BY category, word)
SELECT category, word, cnt FROM (
  SELECT category, word, cnt,
         row_number() OVER (PARTITION BY category ORDER BY cnt DESC, word ASC) AS rk
  FROM c) WHERE rk <= {B.TOP_K}"""


def _aspect_sql(sentiment: str, name: str) -> str:
    return f"""WITH {_REVIEWS}
SELECT upper(aspect) AS aspect, count(rid) AS {name} FROM rv
WHERE lower(sentiment) = '{sentiment}'
GROUP BY upper(aspect) ORDER BY {name} DESC, aspect ASC NULLS FIRST LIMIT 1"""


_UNSTOPPED = f"""{_REVIEWS},
  tok AS (SELECT rid, upper(category) AS category, upper(aspect) AS aspect, lower(sentiment) AS sentiment,
                 unnest(string_split_regex(lower(review), '{_DELIMS}')) AS word FROM rv),
  stop AS (SELECT unnest(string_split_regex(lower(text), '[ \\t\\n\\x0B\\f\\r]+')) AS word FROM benchmark),
  words AS (SELECT * FROM tok WHERE word <> '' AND regexp_matches(word, '[^\\x00-\\x20]')
              AND NOT EXISTS (SELECT 1 FROM stop WHERE stop.word = tok.word))"""

_LINES = {
    "ratings_from_lines": """
WITH r AS (SELECT l_orderkey % 7 AS k, l_linenumber AS n, o_custkey AS u, l_partkey AS i, l_quantity AS q
           FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey)
SELECT coalesce(u::VARCHAR, '') AS user_id, i::VARCHAR AS item_id, q AS rating,
       CASE WHEN k = 1 THEN NULL ELSE n::BIGINT END AS ts
FROM r WHERE k IN (0, 1, 5, 6)""",
    "items_from_lines": """
SELECT p_partkey::VARCHAR AS item_id, p_name AS title,
       CASE WHEN p_partkey % 5 = 0 THEN NULL ELSE replace(p_name, ' ', ', ') END AS genres
FROM part WHERE p_partkey % 5 IN (0, 3, 4)""",
    "users_from_lines": """
SELECT c_custkey::VARCHAR AS user_id, left(c_mktsegment, 1) AS gender,
       CASE WHEN k = 1 THEN NULL ELSE floor(c_acctbal)::INTEGER END AS age,
       CASE WHEN k >= 3 THEN c_nationkey::INTEGER END AS occupation, CASE WHEN k >= 3 THEN '0 1' END AS zip
FROM (SELECT *, c_custkey % 5 AS k FROM customer) WHERE k > 0""",
    "reviews_from_lines": f"""
WITH {_REVIEWS},
  t AS (SELECT *, rid % 6 AS k, string_split(regexp_replace(review, '[\\n\\r]', ' ', 'g') || ';' || category || ';' || aspect || ';' || sentiment, ';') AS f FROM rv)
SELECT CASE WHEN k = 2 THEN NULL ELSE rid::INTEGER END AS rid,
       CASE WHEN k = 1 THEN NULL ELSE nullif(f[1], '') END AS review,
       CASE WHEN k = 1 THEN category WHEN k = 0 AND len(f) = 4 THEN NULL ELSE nullif(f[2], '') END AS category,
       CASE WHEN k = 1 THEN aspect WHEN k = 0 AND len(f) < 6 THEN NULL ELSE nullif(f[3], '') END AS aspect,
       CASE WHEN k = 1 THEN sentiment WHEN k = 0 AND len(f) < 7 THEN NULL ELSE nullif(f[4], '') END AS sentiment
FROM t""",
}


def oracle_sql() -> dict[str, str]:
    sql = _oracle_sql()
    return sql | text_files.oracle_sql(sql, _item_lines_sql(ordered=True), _REVIEWS)


def _oracle_sql() -> dict[str, str]:
    return _LINES | {
        "ratings_union": f"""
SELECT o.o_custkey AS user_id, l.l_partkey AS item_id, l.l_quantity AS rating
FROM lineitem l LEFT JOIN orders o ON l.l_orderkey = o.o_orderkey
WHERE l.l_linestatus IN ({_HALVES})""",
        "rating_avg_by_item": f"""WITH {_PER_ITEM}
SELECT item_id, title, round(avg_rating, {DIGITS}) AS avg_rating, n_ratings FROM it""",
        "top_rated_item": f"""WITH {_PER_ITEM},
  best AS (SELECT * FROM it
           WHERE n_ratings >= {B.TOP_ITEM_MIN_COUNT} AND NOT isnan(avg_rating)
           ORDER BY avg_rating DESC, CAST(item_id AS VARCHAR) ASC NULLS FIRST LIMIT 1)
SELECT best.item_id, best.title, round(best.avg_rating, {DIGITS}) AS avg_rating, best.n_ratings
FROM (SELECT 1 AS one) d LEFT JOIN best ON TRUE""",
        "genre_rating_pairs": f"""WITH {_GENRE_PAIRS}
SELECT genre, rating FROM pairs""",
        "rating_avg_by_genre": f"""WITH {_GENRE_PAIRS}
SELECT trim(genre) AS genre, round(avg(rating), {DIGITS}) AS avg_rating,
       count(rating) AS n_ratings
FROM pairs GROUP BY trim(genre)""",
        "rating_avg_by_gender": f"""WITH {_USERS},
  s AS (SELECT item_id,
               coalesce(avg(CASE WHEN upper(gender) = 'M' THEN rating END), 0.0) AS male_avg,
               coalesce(avg(CASE WHEN upper(gender) = 'F' THEN rating END), 0.0) AS female_avg
        FROM ru GROUP BY item_id)
SELECT s.item_id, coalesce(t.title, CAST(s.item_id AS VARCHAR)) AS title,
       round(s.male_avg, {DIGITS}) AS male_avg, round(s.female_avg, {DIGITS}) AS female_avg
FROM s LEFT JOIN t ON s.item_id = t.item_id""",
        "rating_avg_by_age_group": _age_sql(),
        "item_report_lines": _item_lines_sql(),
        "genre_report_lines": f"""WITH {_GENRE_PAIRS},
  g2 AS (SELECT trim(genre) AS genre, avg(rating) AS a, count(rating) AS n
         FROM pairs GROUP BY trim(genre))
SELECT genre AS key, {_fmt2('a')} || ' (TotalRatings: ' || n || ')' AS value FROM g2""",
        "gender_report_lines": f"""WITH {_USERS},
  s AS (SELECT item_id,
               coalesce(avg(CASE WHEN upper(gender) = 'M' THEN rating END), 0.0) AS m,
               coalesce(avg(CASE WHEN upper(gender) = 'F' THEN rating END), 0.0) AS f
        FROM ru GROUP BY item_id)
SELECT coalesce(t.title, CAST(s.item_id AS VARCHAR)) AS key,
       'Male_Avg: ' || {_fmt2('s.m')} || ', Female_Avg: ' || {_fmt2('s.f')} AS value
FROM s LEFT JOIN t ON s.item_id = t.item_id""",
        "age_group_report_lines": _age_lines_sql(),
        "clean_words": f"""WITH {_WORDS}
SELECT rid, category, aspect, sentiment, word FROM words""",
        "word_freq_over": f"""WITH {_WORDS}
SELECT word, count(rid) AS freq FROM words GROUP BY word
HAVING count(rid) > {B.WORD_FREQ_THRESHOLD}""",
        "count_by_category": """
SELECT source AS category, count(doc_id) AS total_rows,
       count(DISTINCT doc_id) AS distinct_comments
FROM documents GROUP BY source""",
        "count_by_aspect": """
SELECT role AS aspect, count(conv_id) AS total_rows,
       count(DISTINCT conv_id) AS distinct_comments
FROM conversations GROUP BY role""",
        "most_negative_aspect": _aspect_sql("negative", "neg_count"),
        "most_positive_aspect": _aspect_sql("positive", "pos_count"),
        "word_count_by_category_sentiment": f"""WITH {_WORDS}
SELECT category, sentiment, word, count(rid) AS cnt FROM words
GROUP BY category, sentiment, word""",
        "word_count_by_category": f"""WITH {_WORDS}
SELECT category, word, count(rid) AS cnt FROM words GROUP BY category, word""",
        "top5_positive_words": _top_words_sql("WHERE sentiment = 'positive'"),
        "top5_negative_words": _top_words_sql("WHERE sentiment = 'negative'"),
        "top5_related_words": _top_words_sql(""),
        "clean_words_stop_table": f"""WITH {_UNSTOPPED}
SELECT rid, category, aspect, sentiment, word FROM words""",
        "word_freq_stop_table": f"""WITH {_UNSTOPPED}
SELECT word, count(rid) AS freq FROM words GROUP BY word""",
        "document_words_labelled": f"""WITH {_WORDS},
  n AS (SELECT rid AS doc_id, count(*) AS n_words FROM words GROUP BY rid),
  l AS (SELECT doc_id, max('quality ' || quality) AS label FROM labels GROUP BY doc_id)
SELECT n.doc_id, n_words, coalesce(label, n.doc_id::VARCHAR) AS label FROM n LEFT JOIN l ON n.doc_id = l.doc_id""",
    }
