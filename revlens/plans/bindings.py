"""Map the driver's parquet tables onto the ratings / reviews data model.

* ratings = ``lineitem``: item = ``l_partkey``, rating = ``l_quantity``; the
  two rating files, which only ``ratings_union`` reads apart, are the
  ``l_linestatus`` 'O' and 'F' halves.  A rating's user is the
  ``o_custkey`` of its order, looked up only by queries that need users.
* items = ``part``: id = ``p_partkey``, title = ``p_name``, genres = the
  words of ``p_name`` (space separated).
* users = ``customer``: gender label from ``c_mktsegment`` (MACHINERY = M,
  FURNITURE = F, the other segments keep their name and count for neither
  side), age = ``c_acctbal``.
* reviews = ``documents`` left join ``labels``: rid = ``doc_id``, review =
  ``text``, category = ``source``, aspect = ``lang``, sentiment from the
  labels.  Queries that never read sentiment skip the labels join (labels
  hold one row per document, so the join adds no rows).
* conversation judgements = ``conversations``: rid = ``conv_id``,
  aspect = ``role`` (comment ids repeat, so distinct counts are tested).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from revlens.functions.text import WHITESPACE_TOKEN_DELIMITERS

# Fixed values of the binding.
RATING_HALVES = ("O", "F")
MALE_SEGMENT = "MACHINERY"
FEMALE_SEGMENT = "FURNITURE"
AGE_BOUNDS = (0, 2500, 5000, 7500)
TOP_ITEM_MIN_COUNT = 35
WORD_FREQ_THRESHOLD = 500
TOP_K = 5
STOP_WORDS = ("the", "of", "and", "to", "in", "a", "de", "|")
TOKEN_DELIMITERS = WHITESPACE_TOKEN_DELIMITERS
ITEM_GENRE_SEPARATOR = " "


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table with the schema of its files; using a column that it lacks raises."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ratings_from(lineitem: DataFrame) -> DataFrame:
    """``item_id, rating, order_key`` from a lineitem table (no user lookup)."""
    return lineitem.select(F.col("l_partkey").alias("item_id"), F.col("l_quantity").alias("rating"),
                           F.col("l_orderkey").alias("order_key"))


def ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``item_id, rating, order_key`` of all ratings (no user lookup)."""
    return ratings_from(table(spark, sf_dir, "lineitem"))


def rating_half(spark: SparkSession, sf_dir: str, half: str) -> DataFrame:
    """The ratings of one of the two rating files."""
    return ratings_from(table(spark, sf_dir, "lineitem").where(F.col("l_linestatus") == half))


def order_users_from(orders: DataFrame) -> DataFrame:
    """``order_key, user_id`` from an orders table."""
    return orders.select(F.col("o_orderkey").alias("order_key"),
                         F.col("o_custkey").alias("user_id"))


def order_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``order_key, user_id``."""
    return order_users_from(table(spark, sf_dir, "orders"))


def ratings_with_user(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``user_id, item_id, rating``; user is null when the order is unknown."""
    from revlens.operators.ratings import union_ratings
    halves = [rating_half(spark, sf_dir, h) for h in RATING_HALVES]
    r = union_ratings(*halves).join(order_users(spark, sf_dir), "order_key", "left")
    return r.select("user_id", "item_id", "rating")


def users_from(customer: DataFrame) -> DataFrame:
    """``user_id, gender, age`` from a customer table."""
    seg = F.col("c_mktsegment")
    gender = (F.when(seg == MALE_SEGMENT, F.lit("M"))
               .when(seg == FEMALE_SEGMENT, F.lit("F"))
               .otherwise(seg))
    return customer.select(F.col("c_custkey").alias("user_id"), gender.alias("gender"),
                           F.col("c_acctbal").alias("age"))


def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``user_id, gender, age``."""
    return users_from(table(spark, sf_dir, "customer"))


def rated_by_known_users_from(lineitem: DataFrame, orders: DataFrame, customer: DataFrame,
                              *user_cols: str) -> DataFrame:
    """``item_id, rating, <user_cols>`` for ratings whose user is known.

    Equal to the ratings inner-joined to their order's user, but joins
    orders to users first so the rating-sized side is shuffled once (and
    not at all when lineitem is stored bucketed by order key).
    ``gender_side`` and ``age_group`` are coded once per user.
    """
    from revlens.operators.ratings import age_groups, gender_sides, one_row_per_user
    people = one_row_per_user(users_from(customer))
    if "gender_side" in user_cols:
        people = gender_sides(people)
    if "age_group" in user_cols:
        people = age_groups(people, AGE_BOUNDS)
    known = order_users_from(orders).join(
        people.select("user_id", *user_cols), "user_id", "inner")
    return ratings_from(lineitem).join(known, "order_key", "inner").select(
        "item_id", "rating", *user_cols)


def rated_by_known_users(spark: SparkSession, sf_dir: str, *user_cols: str) -> DataFrame:
    """``rated_by_known_users_from`` over the parquet tables."""
    return rated_by_known_users_from(table(spark, sf_dir, "lineitem"),
                                     table(spark, sf_dir, "orders"),
                                     table(spark, sf_dir, "customer"), *user_cols)


def items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``item_id, title, genres``."""
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("item_id"), F.col("p_name").alias("title"),
        F.col("p_name").alias("genres"))


def _sentiment(labelled: F.Column) -> F.Column:
    return (F.when(F.col("toxic") == 1, F.lit("negative"))
             .when(F.col("quality") == 1, F.lit("positive"))
             .when(labelled, F.lit("neutral"))
             .otherwise(F.lit("unlabelled")))


def reviews_from(documents: DataFrame, labels: DataFrame | None) -> DataFrame:
    """``rid, review, category, aspect[, sentiment]`` from the two tables.

    ``labels`` None gives the sentiment-free form (no join).
    """
    docs = documents.select(
        F.col("doc_id").alias("rid"), F.col("text").alias("review"),
        F.col("source").alias("category"), F.col("lang").alias("aspect"))
    if labels is None:
        return docs
    lab = labels.select(F.col("doc_id").alias("rid"), "quality", "toxic",
                        F.lit(True).alias("_labelled"))
    joined = docs.join(lab, "rid", "left")
    return joined.select("rid", "review", "category", "aspect",
                         _sentiment(F.col("_labelled").isNotNull()).alias("sentiment"))


def reviews(spark: SparkSession, sf_dir: str, with_sentiment: bool = True) -> DataFrame:
    """``rid, review, category, aspect[, sentiment]``."""
    documents = table(spark, sf_dir, "documents")
    labels = table(spark, sf_dir, "labels") if with_sentiment else None
    return reviews_from(documents, labels)


def conversation_judgements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``rid, aspect`` from conversation turns."""
    return table(spark, sf_dir, "conversations").select(
        F.col("conv_id").alias("rid"), F.col("role").alias("aspect"))


def benchmark_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stop table: the words of the benchmark texts, repeats kept."""
    text = table(spark, sf_dir, "benchmark").select(F.explode(F.split(F.lower("text"), "[ \\t\\n\\x0B\\f\\r]+")).alias("word"))
    return text.where(F.col("word") != "")


# The text inputs as lines, rendered from whole tables: padded lines, blank
# lines, short lines and trailing empty fields are mixed in by key.

def rating_lines(spark: SparkSession, sf_dir: str, *keep: str) -> DataFrame:
    """``value``: ``user, item, rating[, time]`` lines; ``keep`` columns of lineitem beside them."""
    r = (table(spark, sf_dir, "lineitem").join(table(spark, sf_dir, "orders"), F.col("l_orderkey") == F.col("o_orderkey"), "left")
         .select("l_orderkey", "l_linenumber", "o_custkey", "l_partkey", "l_quantity"))
    k = F.col("l_orderkey") % 7
    user, item, rating = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("o_custkey", "l_partkey", "l_quantity"))
    line = (F.when(k == 0, F.concat(user, F.lit(","), item, F.lit(",  "), rating, F.lit(","), F.col("l_linenumber").cast("string")))
             .when(k == 1, F.concat(F.lit("  "), user, F.lit(", "), item, F.lit(", "), rating, F.lit(" \t")))
             .when(k == 2, F.concat(user, F.lit(", "), item))
             .when(k == 3, F.lit("  "))
             .when(k == 4, F.concat(user, F.lit(","), item, F.lit(",,")))
             .otherwise(F.concat_ws(", ", user, item, rating, F.col("l_linenumber").cast("string"))))
    return r.select(line.alias("value"), *keep)


def item_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``value``: ``id, title, genres`` lines; the genres text holds commas."""
    k = F.col("p_partkey") % 5
    item, genres = F.col("p_partkey").cast("string"), F.regexp_replace("p_name", " ", ", ")
    line = (F.when(k == 0, F.concat(F.lit(" "), item, F.lit(","), F.col("p_name")))
             .when(k == 1, item)
             .when(k == 2, F.lit(""))
             .otherwise(F.concat_ws(", ", item, "p_name", genres)))
    return table(spark, sf_dir, "part").select(line.alias("value"))


def user_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``value``: ``id, gender, age, occupation, zip`` lines."""
    k = F.col("c_custkey") % 5
    user, gender = F.col("c_custkey").cast("string"), F.substring("c_mktsegment", 1, 1)
    age = F.floor("c_acctbal").cast("string")
    line = (F.when(k == 0, F.concat(user, F.lit(",")))
             .when(k == 1, F.concat(user, F.lit(","), gender, F.lit(",x,,")))
             .when(k == 2, F.concat_ws(",", user, gender, age))
             .otherwise(F.concat_ws(",  ", user, gender, age, F.col("c_nationkey").cast("string"), F.lit("0 1"))))
    return table(spark, sf_dir, "customer").select(line.alias("value"))


def review_lines(spark: SparkSession, sf_dir: str, *keep: str) -> DataFrame:
    """``value``: ``rid;review;category;aspect;sentiment`` lines; a ``;`` in a text moves the later fields."""
    r = reviews(spark, sf_dir)
    k = F.col("rid") % 6
    rid, text = F.col("rid").cast("string"), F.regexp_replace("review", "[\n\r]", " ")
    line = (F.when(k == 0, F.concat_ws(";", rid, text))
             .when(k == 1, F.concat_ws(";", rid, F.lit(""), "category", "aspect", "sentiment", F.lit("more"), F.lit("")))
             .when(k == 2, F.concat_ws(";", F.concat(F.lit("x"), rid), text, "category", "aspect", "sentiment"))
             .otherwise(F.concat_ws(";", rid, text, "category", "aspect", "sentiment")))
    return r.select(line.alias("value"), *keep)
