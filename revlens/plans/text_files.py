"""Queries over text files: whole tables are written as lines under the shared folder and read back.

The files stay under ``spark.checkpoint.dir`` for as long as the lazy result
may be read; a run writes folders of its own.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from revlens.functions.numbers import java_double, loaded_int
from revlens.functions.text import java_trim
from revlens.operators import ratings as R
from revlens.operators import reviews as V
from revlens.operators.numbering import numbered
from revlens.plans import bindings as B
from revlens.plans.report import item_report_lines
from revlens.session import ensure_checkpoint_dir
from revlens.sources import (parse_ratings, read_items, read_lines, read_pairs, read_ratings, read_reviews, read_users,
                             read_word_list, write_tsv)

DIGITS = 6


def folder(spark: SparkSession, name: str) -> str:
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def written(lines: DataFrame, name: str, *order: str | Column) -> str:
    """Writes the ``value`` lines, in order if one is given, and returns their folder."""
    path = folder(lines.sparkSession, name)
    (lines.orderBy(*order) if order else lines).select("value").write.text(path)
    return path


def dealt(lines: DataFrame, number: Column, n: int, name: str) -> list[str]:
    """Writes the lines to ``n`` folders by ``number``; an input without lines is an empty folder."""
    return [written(lines.where(number == i), f"{name}-{i}") for i in range(n)]


# ------------------------------------------------------------- several inputs

def _rating_files(spark: SparkSession, d: str) -> list[str]:
    return dealt(B.rating_lines(spark, d, "l_linenumber"), F.col("l_linenumber") % 3, 3, "ratings")


def q_ratings_from_files(spark: SparkSession, d: str) -> DataFrame:
    """Ratings of three text inputs, each row with its input's number."""
    got = read_ratings(spark, _rating_files(spark, d), order=True)
    return got.select(F.col("line_order.input").alias("input"), "user_id", "item_id", "rating", "ts")


def q_rating_file_counts(spark: SparkSession, d: str) -> DataFrame:
    """Lines and rating rows of each of four inputs, the last of which is the first one again."""
    files = _rating_files(spark, d)
    lines = read_lines(spark, [*files, files[0]], order=True)
    number = F.col("line_order.input").alias("input")
    n_lines = lines.groupBy(number).agg(F.count("*").alias("n_lines"))
    n_rows = parse_ratings(lines).groupBy(number).agg(F.count("*").alias("n_rows"))
    return n_lines.join(n_rows, "input", "left").select("input", "n_lines", F.coalesce("n_rows", F.lit(0)).alias("n_rows"))


def q_word_freq_stop_file(spark: SparkSession, d: str) -> DataFrame:
    """Word frequencies without the words of two stop-word files."""
    words = B.benchmark_words(spark, d).select(F.col("word").alias("value"))
    stop = read_word_list(spark, dealt(words, F.pmod(F.crc32("value"), F.lit(2)), 2, "stop"))
    return V.word_freq_over(V.clean_words(B.reviews(spark, d, False), stop, B.TOKEN_DELIMITERS), 0)


# ------------------------------------------------------------ the last line wins

def q_titles_last_line(spark: SparkSession, d: str) -> DataFrame:
    """Item averages, where an item's title is that of its last line in two item files."""
    part = B.table(spark, d, "part").select(F.col("p_partkey").alias("p"), "p_name")

    def lines(rows: DataFrame, at: int, word: str) -> DataFrame:
        return rows.select(F.concat_ws(", ", F.col("p").cast("string"), F.concat(F.lit(word), "p_name"), F.lit("x")).alias("value"),
                           F.lit(at).alias("at"), "p")

    first = lines(part, 0, "z ").unionByName(lines(part.where("p % 2 = 0"), 1, "m "))
    files = [written(first, "items", "at", "p"), written(lines(part.where("p % 3 = 0"), 0, "a "), "items")]
    rated = B.ratings(spark, d).withColumn("item_id", F.col("item_id").cast("string"))
    out = R.rating_avg_by_item(rated, read_items(spark, files, order=True))
    return out.withColumn("avg_rating", F.round("avg_rating", DIGITS))


def q_gender_last_line(spark: SparkSession, d: str) -> DataFrame:
    """Averages per gender, where a user's gender is that of the last line in two user files."""
    people = B.table(spark, d, "customer").select(F.col("c_custkey").alias("c"))

    def lines(rows: DataFrame, at: int, gender: str) -> DataFrame:
        return rows.select(F.concat_ws(",", F.col("c").cast("string"), F.lit(gender), F.lit("30")).alias("value"), F.lit(at).alias("at"), "c")

    first = lines(people, 0, "M").unionByName(lines(people.where("c % 2 = 0"), 1, "f"))
    files = [written(first, "users", "at", "c"), written(lines(people.where("c % 5 = 0"), 0, "X"), "users")]
    as_text = lambda df, *names: df.withColumns({c: F.col(c).cast("string") for c in names})
    out = R.rating_avg_by_gender(as_text(B.ratings_with_user(spark, d), "user_id", "item_id"), read_users(spark, files, order=True),
                                 as_text(B.items(spark, d), "item_id"))
    return out.withColumns({c: F.round(c, DIGITS) for c in ("male_avg", "female_avg")})


# ------------------------------------------------------------------- reviews

def q_reviews_from_files(spark: SparkSession, d: str) -> DataFrame:
    """Reviews of three files: one that opens with a byte-order mark, and two where the same character opens later lines."""
    lines = B.review_lines(spark, d, "rid")
    least = lines.agg(F.min("rid")).first()[0]
    mark = F.lit("\ufeff")
    opening = lines.where(F.col("rid") == least).select(F.concat(mark, "value").alias("value"))
    rest = lines.where(F.col("rid") != least)
    later = F.when(F.col("rid") % 6 == 5, F.concat(F.lit("\n"), mark, "value")).otherwise(F.col("value"))
    files = dealt(rest.select("rid", later.alias("value")), F.col("rid") % 2, 2, "reviews")
    return read_reviews(spark, [written(opening.coalesce(1), "reviews"), *files])


def _quoted(text: Column) -> Column:
    return F.concat(F.lit('"'), F.replace(text, F.lit('"'), F.lit('""')), F.lit('"'))


def q_reviews_from_quoted_lines(spark: SparkSession, d: str) -> DataFrame:
    """Reviews of quoted lines: separators and doubled quotes within, blanks before, text after, quotes not at the start or not closed."""
    r = B.reviews(spark, d)
    k, rid = F.col("rid") % 5, F.col("rid").cast("string")
    text = F.regexp_replace("review", "[\n\r]", " ")
    line = (F.when(k == 0, F.concat_ws(";", rid, _quoted(text), "category", "aspect", "sentiment"))
             .when(k == 1, F.concat_ws(";", _quoted(rid), F.concat(F.lit(" \t"), _quoted(text)), *(_quoted(F.col(c)) for c in ("category", "aspect", "sentiment")),
                                       F.lit("more"), F.lit('"x;y"'), F.lit("")))
             .when(k == 2, F.concat_ws(";", rid, F.concat(_quoted(text), F.lit("tail")), F.lit('""'), "aspect", F.lit("")))
             .when(k == 3, F.concat(F.concat_ws(";", rid, F.lit('a"b"'), "category"), F.lit("\n  ")))
             .otherwise(F.concat_ws(";", rid, F.concat(F.lit('"'), F.replace(text, F.lit('"'), F.lit('""'))), "category")))
    return read_reviews(spark, written(r.select(line.alias("value")), "quoted"), quoting=True)


def q_reviews_from_quoted_records(spark: SparkSession, d: str) -> DataFrame:
    """Reviews of quoted records, whose texts go over several lines."""
    r = B.reviews(spark, d)
    k, rid = F.col("rid") % 3, F.col("rid").cast("string")
    line = (F.when(k == 0, F.concat_ws(";", rid, _quoted(F.col("review")), _quoted(F.col("category")), "aspect", "sentiment"))
             .when(k == 1, F.concat_ws(";", rid, F.lit("5\" x"), "category"))
             .otherwise(F.concat_ws(";", rid, _quoted(F.concat(F.lit('"a";\n;"\n'), F.col("review"), F.lit('"'))), "category", _quoted(F.col("aspect")))))
    return read_reviews(spark, written(r.select(line.alias("value")), "records"), quoting=True, multiline=True)


# ------------------------------------------------------- stored results, read again

def q_genre_avg_from_stored_pairs(spark: SparkSession, d: str) -> DataFrame:
    """Averages per genre in two jobs: the (genre, rating) pairs are stored, then read by a job of their own."""
    pairs = R.genre_rating_pairs(B.ratings(spark, d), R.explode_genres(B.items(spark, d), B.ITEM_GENRE_SEPARATOR))
    path = folder(spark, "pairs")
    write_tsv(pairs, path)
    stored = read_pairs(spark, path).groupBy("genre").agg(F.avg("rating").alias("avg_rating"), F.count("rating").alias("n_ratings"))
    return stored.withColumn("avg_rating", F.round("avg_rating", DIGITS))


def q_report_from_sinks(spark: SparkSession, d: str) -> DataFrame:
    """The item report as four sinks keep it: one that refuses a second write, one that replaces, one file in order, and one row."""
    stats = R.item_stats(B.ratings(spark, d))
    report = item_report_lines(stats, B.items(spark, d), B.TOP_ITEM_MIN_COUNT, True)
    plain, winner = report.drop("_top", "_id"), report.where("_top = 1").drop("_top", "_id")
    paths = {name: folder(spark, name) for name in ("refused", "replaced", "single", "winner")}
    write_tsv(plain, paths["refused"])
    try:
        write_tsv(winner, paths["refused"])
        raise RuntimeError("a sink wrote over an existing folder")
    except AnalysisException:
        pass
    write_tsv(winner, paths["replaced"], "overwrite")
    write_tsv(plain, paths["replaced"], "overwrite")
    write_tsv(report, paths["single"], single_file=True, order_by=["_top", "_id"], hidden=["_top", "_id"])
    write_tsv(winner, paths["winner"], single_file=True)
    f = F.split("value", "\t", 2)
    return R.union_ratings(*[read_lines(spark, path).select(F.lit(name).alias("sink"), f[0].alias("key"), f[1].alias("value"))
                             for name, path in paths.items()])


def q_item_report_numbered(spark: SparkSession, d: str) -> DataFrame:
    """The item report with each line's number in the original file's order."""
    report = item_report_lines(R.item_stats(B.ratings(spark, d)), B.items(spark, d), B.TOP_ITEM_MIN_COUNT, True)
    return numbered(report, ["_top", "_id"]).select("line", "key", "value")


def q_numbers_from_text(spark: SparkSession, d: str) -> DataFrame:
    """Number texts of nine forms, as the loaders' integer and double."""
    r = B.table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", F.col("l_quantity").cast("int").alias("q"))
    k = (F.col("l_orderkey") + F.col("l_linenumber")) % 9
    p, q = F.col("l_partkey").cast("string"), F.col("q").cast("string")
    text = (F.when(k == 0, F.concat(q, F.lit(".7")))
             .when(k == 1, F.concat(F.lit(" "), q, F.lit("\t")))
             .when(k == 2, F.concat(F.lit("0x"), F.hex("l_partkey"), F.lit("p-2")))
             .when(k == 3, F.concat(F.lit("-0X."), F.lpad(F.lower(F.hex("l_partkey")), 8, "0"), F.lit("P12f")))
             .when(k == 4, F.concat(p, F.lit("000000000")))
             .when(k == 5, F.concat(F.lit("x"), p))
             .when(k == 6, F.concat(F.lit("-"), q, F.lit(".999d")))
             .when(k == 7, F.lit("inf"))
             .otherwise(F.concat(F.lit("1e"), F.col("l_linenumber").cast("string"))))
    rows = r.select("l_orderkey", "l_linenumber", text.alias("text"))
    return rows.select("*", loaded_int(F.col("text")).alias("as_int"), java_double(java_trim("text")).alias("as_double"))


def queries():
    return {f.__name__[2:]: f for f in (
        q_ratings_from_files, q_rating_file_counts, q_word_freq_stop_file, q_titles_last_line, q_gender_last_line, q_reviews_from_files,
        q_reviews_from_quoted_lines, q_reviews_from_quoted_records, q_genre_avg_from_stored_pairs, q_report_from_sinks,
        q_item_report_numbered, q_numbers_from_text)}


_RATING_ROWS = """r AS (SELECT l_orderkey % 7 AS k, l_linenumber AS n, o_custkey AS u, l_partkey AS i, l_quantity AS q
           FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey)"""


def oracle_sql(shared: dict[str, str], item_lines: str, reviews: str) -> dict[str, str]:
    """``shared``: SQL of queries with the same rows; ``item_lines``: the item report with its order; ``reviews``: the reviews' CTE."""
    return {
        "ratings_from_files": f"""
WITH {_RATING_ROWS}
SELECT (n % 3)::INTEGER AS input, coalesce(u::VARCHAR, '') AS user_id, i::VARCHAR AS item_id, q AS rating,
       CASE WHEN k = 1 THEN NULL ELSE n::BIGINT END AS ts
FROM r WHERE k IN (0, 1, 5, 6)""",
        "rating_file_counts": f"""
WITH {_RATING_ROWS}, f AS (SELECT n % 3 AS input, k FROM r UNION ALL SELECT 3, k FROM r WHERE n % 3 = 0)
SELECT input::INTEGER AS input, count(*) AS n_lines, count(*) FILTER (k IN (0, 1, 5, 6)) AS n_rows FROM f GROUP BY input""",
        "word_freq_stop_file": shared["word_freq_stop_table"],
        "titles_last_line": f"""
WITH a AS (SELECT l_partkey AS p, avg(l_quantity) AS m, count(l_quantity) AS n FROM lineitem GROUP BY 1)
SELECT p::VARCHAR AS item_id, round(m, {DIGITS}) AS avg_rating, n AS n_ratings,
       coalesce(CASE WHEN p % 3 = 0 THEN 'a ' WHEN p % 2 = 0 THEN 'm ' ELSE 'z ' END || p_name, p::VARCHAR) AS title
FROM a LEFT JOIN part ON p = p_partkey""",
        "gender_last_line": f"""
WITH r AS (SELECT l_partkey AS p, l_quantity AS q, CASE WHEN c_custkey % 5 = 0 THEN 'X' WHEN c_custkey % 2 = 0 THEN 'F' ELSE 'M' END AS g
           FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey),
s AS (SELECT p, coalesce(avg(CASE WHEN g = 'M' THEN q END), 0) AS m, coalesce(avg(CASE WHEN g = 'F' THEN q END), 0) AS f FROM r GROUP BY p)
SELECT p::VARCHAR AS item_id, coalesce(p_name, p::VARCHAR) AS title, round(m, {DIGITS}) AS male_avg, round(f, {DIGITS}) AS female_avg
FROM s LEFT JOIN part ON p = p_partkey""",
        "reviews_from_files": f"""
WITH {reviews},
  t AS (SELECT *, rid % 6 AS k, rid > (SELECT min(rid) FROM rv) AS later,
               string_split(regexp_replace(review, '[\n\r]', ' ', 'g') || ';' || category || ';' || aspect || ';' || sentiment, ';') AS f FROM rv)
SELECT CASE WHEN k = 2 OR k = 5 AND later THEN NULL ELSE rid::INTEGER END AS rid,
       CASE WHEN k = 1 THEN NULL ELSE nullif(f[1], '') END AS review,
       CASE WHEN k = 1 THEN category WHEN k = 0 AND len(f) = 4 THEN NULL ELSE nullif(f[2], '') END AS category,
       CASE WHEN k = 1 THEN aspect WHEN k = 0 AND len(f) < 6 THEN NULL ELSE nullif(f[3], '') END AS aspect,
       CASE WHEN k = 1 THEN sentiment WHEN k = 0 AND len(f) < 7 THEN NULL ELSE nullif(f[4], '') END AS sentiment
FROM t UNION ALL SELECT NULL, NULL, NULL, NULL, NULL FROM t WHERE k = 5 AND later""",
        "reviews_from_quoted_lines": f"""
WITH {reviews}, t AS (SELECT *, rid % 5 AS k, regexp_replace(review, '[\n\r]', ' ', 'g') AS x FROM rv)
SELECT rid::INTEGER AS rid,
       CASE k WHEN 2 THEN x || 'tail' WHEN 3 THEN 'a"b"' WHEN 4 THEN x || ';' || category ELSE x END AS review,
       CASE k WHEN 2 THEN '' WHEN 4 THEN NULL ELSE category END AS category,
       CASE WHEN k < 3 THEN aspect END AS aspect, CASE WHEN k < 2 THEN sentiment END AS sentiment
FROM t""",
        "reviews_from_quoted_records": f"""
WITH {reviews}, t AS (SELECT *, rid % 3 AS k FROM rv)
SELECT rid::INTEGER AS rid,
       CASE k WHEN 0 THEN review WHEN 1 THEN '5" x' ELSE '"a";' || chr(10) || ';"' || chr(10) || review || '"' END AS review,
       category, CASE WHEN k <> 1 THEN aspect END AS aspect, CASE WHEN k = 0 THEN sentiment END AS sentiment
FROM t""",
        "genre_avg_from_stored_pairs": shared["rating_avg_by_genre"],
        "report_from_sinks": f"""
WITH lines AS ({item_lines})
SELECT sink, key, value FROM lines, (SELECT unnest(['refused', 'replaced', 'single']) AS sink)
UNION ALL SELECT 'winner', key, value FROM lines WHERE top = 1""",
        "item_report_numbered": f"""
SELECT row_number() OVER (ORDER BY top, id) AS line, key, value FROM ({item_lines})""",
        "numbers_from_text": """
WITH r AS (SELECT l_orderkey, l_linenumber, l_partkey AS p, l_quantity::INTEGER AS q, (l_orderkey + l_linenumber) % 9 AS k FROM lineitem),
t AS (SELECT *, CASE k WHEN 0 THEN q || '.7' WHEN 1 THEN ' ' || q || chr(9) WHEN 2 THEN '0x' || hex(p) || 'p-2'
                       WHEN 3 THEN '-0X.' || lpad(lower(hex(p)), 8, '0') || 'P12f' WHEN 4 THEN p || '000000000' WHEN 5 THEN 'x' || p
                       WHEN 6 THEN '-' || q || '.999d' WHEN 7 THEN 'inf' ELSE '1e' || l_linenumber END AS text,
      CASE k WHEN 0 THEN (q || '.7')::DOUBLE WHEN 1 THEN q::DOUBLE WHEN 2 THEN p / 4.0::DOUBLE WHEN 3 THEN p / 1048576.0::DOUBLE * -1.0::DOUBLE
             WHEN 4 THEN p * 1e9 WHEN 6 THEN ('-' || q || '.999')::DOUBLE WHEN 8 THEN ('1e' || l_linenumber)::DOUBLE END AS as_double FROM r)
SELECT l_orderkey, l_linenumber, text, CASE WHEN as_double BETWEEN -2147483648 AND 2147483647 THEN trunc(as_double)::INTEGER END AS as_int, as_double FROM t""",
    }
