"""Rating aggregates: per item, per genre, per rater segment and age group.

Inputs are DataFrames with the columns of the rating data model:

* ratings: ``user_id``, ``item_id``, ``rating`` (double)
* items:   ``item_id``, ``title``, ``genres`` (one string, separated values)
* users:   ``user_id``, ``gender``, ``age``

Every aggregate is written aggregate-first, lookup-second: the titles are
joined to one row per rated item, never to the ratings themselves.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from revlens.functions.text import java_split, java_trim
from revlens.operators.joins import ORDER, last_value, lookup_with_fallback

GENRE_SEPARATOR = r"\|"


def union_ratings(*frames: DataFrame) -> DataFrame:
    """Bag union of several rating inputs (duplicates kept)."""
    return reduce(lambda a, b: a.unionByName(b), frames)


def item_stats(ratings: DataFrame) -> DataFrame:
    """``item_id, avg_rating, n_ratings`` over every rating of an item."""
    return ratings.groupBy("item_id").agg(
        F.avg("rating").alias("avg_rating"),
        F.count("rating").alias("n_ratings"))


def with_titles(stats: DataFrame, items: DataFrame) -> DataFrame:
    """Attach ``title``; an item missing from ``items`` is titled by its id."""
    return lookup_with_fallback(stats, items, "item_id", "title")


def rating_avg_by_item(ratings: DataFrame, items: DataFrame) -> DataFrame:
    """``item_id, title, avg_rating, n_ratings``: one row per rated item."""
    return with_titles(item_stats(ratings), items).select(
        "item_id", "title", "avg_rating", "n_ratings")


def top_rated_item(item_rows: DataFrame, min_count: int = 5) -> DataFrame:
    """The best average among items with ``n_ratings >= min_count``.

    ``item_rows`` holds ``item_id, avg_rating, n_ratings`` and optionally
    ``title``.  Always exactly one row; all columns are null when no item
    qualifies.  Ties on the unrounded average go to the smallest id compared
    as text; NaN and null averages never win.  A global aggregate (partial per task,
    then one tiny merge) instead of a sort.
    """
    cols = [c for c in ("item_id", "title", "avg_rating", "n_ratings") if c in item_rows.columns]
    eligible = item_rows.where((F.col("n_ratings") >= min_count)
                               & F.col("avg_rating").isNotNull() & ~F.isnan("avg_rating"))
    best = F.min(F.struct(
        (-F.col("avg_rating")).alias("neg_avg"),
        F.col("item_id").cast("string").alias("id_text"),
        *cols)).alias("best")
    return eligible.agg(best).select(*[f"best.{c}" for c in cols])


def best_rated_item(ratings: DataFrame, items: DataFrame, min_count: int = 5) -> DataFrame:
    """``item_id, title, avg_rating, n_ratings`` of the best-rated item (one row).

    The winner is chosen on ids alone; only its title is then fetched.
    """
    return best_titled(item_stats(ratings), items, min_count)


def best_titled(stats: DataFrame, items: DataFrame, min_count: int = 5) -> DataFrame:
    """``best_rated_item`` from per-item averages.

    The items table is semi-joined to the single winning id in its scan and
    reduced to one row, so neither side of the title join is shuffled by key.
    """
    best = top_rated_item(stats, min_count)
    wanted = items.join(F.broadcast(best.select("item_id")), "item_id", "left_semi")
    title = wanted.agg(F.any_value("item_id").alias("_id"), last_value(wanted, "title").alias("title"))
    return (best.join(F.broadcast(title), F.col("item_id") == F.col("_id"), "left")
            .select("item_id", F.coalesce("title", F.col("item_id").cast("string")).alias("title"),
                    "avg_rating", "n_ratings"))


def explode_genres(items: DataFrame, separator: str = GENRE_SEPARATOR) -> DataFrame:
    """``item_id, genre``: one row per listed genre, repeats kept.

    The genres text is trimmed as a whole, but each genre keeps its own
    surrounding spaces here, as in the (genre, rating) pairs output; the
    per-genre average trims names when it groups them.
    """
    genres = java_split(java_trim("genres"), separator)
    return items.select("item_id", F.explode(genres).alias("genre"))


def genre_rating_pairs(ratings: DataFrame, item_genres: DataFrame) -> DataFrame:
    """``genre, rating`` for every (genre of the item) x (rating of the item).

    Inner join: ratings of unknown items and items without ratings drop out.
    A hot item is split at runtime by AQE's skew join.
    """
    return ratings.join(item_genres, "item_id", "inner").select("genre", "rating")


def item_sums(ratings: DataFrame) -> DataFrame:
    """``item_id, s, n``: the sum and number of an item's ratings."""
    return ratings.groupBy("item_id").agg(F.sum("rating").alias("s"), F.count("rating").alias("n"))


def rating_avg_by_genre(ratings: DataFrame, item_genres: DataFrame) -> DataFrame:
    """``genre, avg_rating, n_ratings``: mean over all ratings of the genre's items.

    Ratings are first reduced to one (sum, count) row per item, so the join
    and the genre shuffle move item-level rows, not rating-level ones; a hot
    item is absorbed by the partial aggregation before any shuffle.
    """
    return genre_averages(item_sums(ratings), item_genres)


def genre_averages(sums: DataFrame, item_genres: DataFrame) -> DataFrame:
    """``rating_avg_by_genre`` from per-item sums."""
    joined = sums.join(item_genres, "item_id", "inner")
    return joined.groupBy(java_trim("genre").alias("genre")).agg(
        F.try_divide(F.sum("s"), F.sum("n")).alias("avg_rating"),
        F.sum("n").alias("n_ratings"))


def one_row_per_user(users: DataFrame, *user_cols: str) -> DataFrame:
    """``user_id, <user_cols>`` (default: all columns, by name) with one row per id.

    All values of an id come from one of its rows.

    A repeated user would multiply ratings in a join.  The last line wins, as
    in the original map, where the reader carried ``line_order``; the largest
    row in a table without order.
    It shuffles by ``user_id``, the key of the join that follows.
    """
    user_cols = user_cols or tuple(sorted(c for c in users.columns if c not in ("user_id", ORDER)))
    row = last_value(users, F.struct(*user_cols)).alias("_row")
    return users.groupBy("user_id").agg(row).select("user_id", *[F.col(f"_row.{c}").alias(c) for c in user_cols])


def rate_by_users(ratings: DataFrame, users: DataFrame, *user_cols: str) -> DataFrame:
    """Inner join ratings to user attributes; ratings of unknown users drop out."""
    return rate_by_people(ratings, one_row_per_user(users, *user_cols), *user_cols)


def rate_by_people(ratings: DataFrame, people: DataFrame, *user_cols: str) -> DataFrame:
    """``rate_by_users`` for a table that has one row per user already."""
    return ratings.join(people.select("user_id", *user_cols), "user_id", "inner")


MALE_SIDE, FEMALE_SIDE = 1, 2


def gender_sides(users: DataFrame, male: str = "M", female: str = "F") -> DataFrame:
    """``user_id, gender_side``: 1 for ``male``, 2 for ``female``, null otherwise.

    Labels match case-insensitively.  Coding the side once per user keeps
    the comparison off the rating rows and ships a tinyint, not a label,
    through the joins.
    """
    if male.upper() == female.upper():
        raise ValueError("male and female labels must differ (case-insensitively)")
    g = F.upper(F.col("gender"))
    side = (F.when(g == male.upper(), F.lit(MALE_SIDE))
             .when(g == female.upper(), F.lit(FEMALE_SIDE))).cast("tinyint")
    keep = [c for c in users.columns if c not in ("user_id", "gender", "gender_side")]
    return users.select("user_id", side.alias("gender_side"), *keep)


def gender_average_columns() -> list[Column]:
    """``male_avg, female_avg`` aggregates over rows carrying ``gender_side``.

    Other users count for neither side, and an empty side is 0.0.
    """
    side = F.col("gender_side")

    def avg_of(code: int, name: str) -> Column:
        return F.coalesce(F.avg(F.when(side == code, F.col("rating"))), F.lit(0.0)).alias(name)

    return [avg_of(MALE_SIDE, "male_avg"), avg_of(FEMALE_SIDE, "female_avg")]


def gender_averages(rated: DataFrame) -> DataFrame:
    """``item_id, male_avg, female_avg`` from ratings carrying ``gender_side``."""
    return rated.groupBy("item_id").agg(*gender_average_columns())


def rating_avg_by_gender(ratings: DataFrame, users: DataFrame, items: DataFrame,
                         male: str = "M", female: str = "F") -> DataFrame:
    """``item_id, title, male_avg, female_avg`` for items rated by known users."""
    rated = rate_by_people(ratings, gender_sides(one_row_per_user(users), male, female), "gender_side")
    return gender_averages_titled(rated, items)


def gender_averages_titled(rated: DataFrame, items: DataFrame) -> DataFrame:
    """``rating_avg_by_gender`` from ratings carrying ``gender_side``."""
    return with_titles(gender_averages(rated), items).select(
        "item_id", "title", "male_avg", "female_avg")


def _check_bounds(bounds: Sequence[float]) -> None:
    if not bounds or list(bounds) != sorted(bounds) or len(set(bounds)) != len(bounds):
        raise ValueError("age bounds must be strictly increasing")


def age_group_names(bounds: Sequence[float]) -> list[tuple[str, str]]:
    """``(label, column)`` per half-open group ``[b_i, b_i+1)`` and ``[b_last, inf)``."""
    _check_bounds(bounds)
    out = []
    for i, lo in enumerate(bounds):
        if i + 1 < len(bounds):
            hi = bounds[i + 1]
            out.append((f"{lo:g}-{hi:g}", f"avg_{lo:g}_{hi:g}"))
        else:
            out.append((f"{lo:g}+", f"avg_{lo:g}_plus"))
    return out


def age_groups(users: DataFrame, bounds: Sequence[float] = (0, 18, 35, 50)) -> DataFrame:
    """``user_id, age_group``: index of the user's half-open group, null if none.

    An age on a boundary belongs to the upper group; ages below the first
    bound (or null) fall in no group.  Computed once per user, so rating
    rows only compare a small integer.
    """
    _check_bounds(bounds)
    age = F.col("age")
    expr = None
    for i in range(len(bounds) - 1, -1, -1):
        cond = age >= bounds[i]
        expr = F.when(cond, F.lit(i)) if expr is None else expr.when(cond, F.lit(i))
    keep = [c for c in users.columns if c not in ("user_id", "age", "age_group")]
    return users.select("user_id", expr.cast("int").alias("age_group"), *keep)


def age_group_average_columns(bounds: Sequence[float] = (0, 18, 35, 50)) -> list[Column]:
    """``avg_<lo>_<hi> ...`` aggregates over rows carrying ``age_group``.

    An empty group is null.  Every group is a conditional average, so all
    take one pass.
    """
    group = F.col("age_group")
    return [F.avg(F.when(group == i, F.col("rating"))).alias(name)
            for i, (_, name) in enumerate(age_group_names(bounds))]


def age_group_averages(rated: DataFrame, bounds: Sequence[float] = (0, 18, 35, 50)) -> DataFrame:
    """``item_id, avg_<lo>_<hi> ...`` from ratings carrying ``age_group``."""
    return rated.groupBy("item_id").agg(*age_group_average_columns(bounds))


def rating_avg_by_age_group(ratings: DataFrame, users: DataFrame, items: DataFrame,
                            bounds: Sequence[float] = (0, 18, 35, 50)) -> DataFrame:
    """``item_id, title, avg_<group>...`` for items rated by known users."""
    rated = rate_by_people(ratings, age_groups(one_row_per_user(users), bounds), "age_group")
    return age_group_averages_titled(rated, items, bounds)


def age_group_averages_titled(rated: DataFrame, items: DataFrame,
                              bounds: Sequence[float] = (0, 18, 35, 50)) -> DataFrame:
    """``rating_avg_by_age_group`` from ratings carrying ``age_group``."""
    cols = [name for _, name in age_group_names(bounds)]
    return with_titles(age_group_averages(rated, bounds), items).select("item_id", "title", *cols)
