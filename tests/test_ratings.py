import math

import pytest

from revlens.operators import ratings as R
from tests.conftest import rows

RATINGS = "user_id string, item_id string, rating double"
ITEMS = "item_id string, title string, genres string"
USERS = "user_id string, gender string, age double"


@pytest.fixture()
def items(spark):
    return spark.createDataFrame([
        ("1", "Alpha", "Action|Drama"),
        ("2", "Beta", "Drama"),
        ("3", "Gamma", "Comedy|Comedy"),   # genre listed twice
        ("4", "Unrated", "Action"),         # no ratings
        ("5", "Trail", "Action|"),          # trailing separator
        ("6", "Blank", " | Horror "),       # blank genre, spaces trimmed
    ], ITEMS)


@pytest.fixture()
def ratings(spark):
    return spark.createDataFrame([
        ("u1", "1", 4.0), ("u2", "1", 5.0),
        ("u1", "2", 3.0),
        ("u3", "3", 2.0), ("u3", "3", 4.0),
        ("u4", "99", 1.0),                   # unknown item
        ("u1", "5", 3.0), ("u2", "6", 5.0),
    ], RATINGS)


def test_union_keeps_duplicates(spark, ratings):
    assert R.union_ratings(ratings, ratings, ratings).count() == 3 * ratings.count()


def test_avg_by_item_and_title_fallback(spark, ratings, items):
    out = rows(R.rating_avg_by_item(ratings, items))
    assert out == [("1", "Alpha", 4.5, 2), ("2", "Beta", 3.0, 1), ("3", "Gamma", 3.0, 2),
                   ("5", "Trail", 3.0, 1), ("6", "Blank", 5.0, 1), ("99", "99", 1.0, 1)]


def test_duplicate_item_id_does_not_multiply(spark, ratings):
    dup = spark.createDataFrame([("1", "A1", ""), ("1", "A2", "")], ITEMS)
    out = rows(R.rating_avg_by_item(ratings.where("item_id = '1'"), dup))
    assert out == [("1", "A2", 4.5, 2)]


def _per_item(spark, data):
    return spark.createDataFrame(data, "item_id string, title string, avg_rating double, "
                                       "n_ratings long")


def test_top_rated_ties_go_to_smallest_id_text(spark):
    per_item = _per_item(spark, [("9", "Nine", 4.5, 5), ("10", "Ten", 4.5, 7),
                                 ("7", "Seven", 5.0, 4)])
    assert rows(R.top_rated_item(per_item, 5)) == [("10", "Ten", 4.5, 7)]


def test_top_rated_min_count_inclusive_and_nan_never_wins(spark):
    per_item = _per_item(spark, [("1", "A", 3.0, 5), ("2", "B", math.nan, 9)])
    assert rows(R.top_rated_item(per_item, 5)) == [("1", "A", 3.0, 5)]


def test_top_rated_none_qualifies_gives_one_null_row(spark):
    per_item = _per_item(spark, [("1", "A", 3.0, 2)])
    assert rows(R.top_rated_item(per_item, 5)) == [(None, None, None, None)]


def test_top_rated_numeric_ids_compare_as_text(spark):
    df = spark.createDataFrame([(9, "Nine", 4.0, 5), (10, "Ten", 4.0, 5)],
                               "item_id long, title string, avg_rating double, n_ratings long")
    assert rows(R.top_rated_item(df, 1), "item_id") == [(10,)]


def test_explode_genres_rules(spark, items):
    out = rows(R.explode_genres(items))
    assert ("3", "Comedy") in out and out.count(("3", "Comedy")) == 2
    assert [g for i, g in out if i == "5"] == ["Action"]
    # names keep their own spaces until the per-genre average trims them
    assert sorted(g for i, g in out if i == "6") == ["", " Horror"]


def test_genre_pairs_and_average(spark, ratings, items):
    genres = R.explode_genres(items)
    pairs = rows(R.genre_rating_pairs(ratings, genres))
    # unknown item 99 and unrated item 4 contribute nothing
    assert len(pairs) == 2 + 2 + 1 + 4 + 1 + 2
    by_genre = {g: (a, n) for g, a, n in rows(R.rating_avg_by_genre(ratings, genres))}
    assert by_genre["Drama"] == (4.0, 3)           # mean over ratings, not over items
    assert by_genre["Comedy"] == (3.0, 4)          # listed twice counts twice
    assert by_genre["Action"] == (4.0, 3)
    assert by_genre[""] == (5.0, 1)
    assert "Horror" in by_genre and "Unrated" not in by_genre


def test_gender_averages(spark, items):
    ratings = spark.createDataFrame([
        ("m1", "1", 4.0), ("f1", "1", 2.0), ("m2", "1", 5.0),
        ("x1", "2", 3.0),                   # only a user of another gender
        ("ghost", "3", 5.0),                # only an unknown user
        ("f1", "88", 1.0),                  # unknown item
    ], RATINGS)
    users = spark.createDataFrame([
        ("m1", "M", 20.0), ("m2", "m", 30.0), ("f1", "F", 40.0), ("x1", "X", 50.0)], USERS)
    out = rows(R.rating_avg_by_gender(ratings, users, items))
    assert out == [("1", "Alpha", 4.5, 2.0), ("2", "Beta", 0.0, 0.0), ("88", "88", 0.0, 1.0)]


def test_age_groups_half_open(spark, items):
    ratings = spark.createDataFrame([
        ("a", "1", 1.0), ("b", "1", 2.0), ("c", "1", 3.0), ("d", "1", 4.0), ("e", "1", 5.0),
        ("neg", "2", 5.0)], RATINGS)
    users = spark.createDataFrame([
        ("a", "F", 17.0), ("b", "M", 18.0), ("c", "M", 35.0), ("d", "F", 50.0),
        ("e", "F", 49.0), ("neg", "M", -3.0)], USERS)
    out = rows(R.rating_avg_by_age_group(ratings, users, items))
    assert out == [("1", "Alpha", 1.0, 2.0, 4.0, 4.0), ("2", "Beta", None, None, None, None)]
    assert [c for _, c in R.age_group_names((0, 18, 35, 50))] == \
        ["avg_0_18", "avg_18_35", "avg_35_50", "avg_50_plus"]


def test_age_bounds_must_increase(spark, ratings):
    with pytest.raises(ValueError):
        R.age_group_averages(ratings, (0, 50, 18))
    with pytest.raises(ValueError):
        R.age_groups(ratings, (18, 18))


def test_best_rated_item_fetches_only_the_winner_title(spark, ratings, items):
    many = R.union_ratings(*[ratings] * 3)
    assert rows(R.best_rated_item(many, items, 3)) == [("6", "Blank", 5.0, 3)]
    assert rows(R.best_rated_item(many, items, 7)) == [(None, None, None, None)]
    # winner missing from the items table falls back to its id
    assert rows(R.best_rated_item(many.where("item_id = '99'"), items, 1)) == \
        [("99", "99", 1.0, 3)]


def test_null_item_id_never_matches_a_title(spark):
    ratings = spark.createDataFrame([("u", None, 2.0), ("v", None, 4.0)], RATINGS)
    items = spark.createDataFrame([(None, "Ghost", "A")], ITEMS)
    assert rows(R.rating_avg_by_item(ratings, items)) == [(None, None, 3.0, 2)]
    assert R.genre_rating_pairs(ratings, R.explode_genres(items)).count() == 0


def test_gender_labels_must_differ(spark, ratings, items):
    users = spark.createDataFrame([("u1", "X", 1.0)], USERS)
    with pytest.raises(ValueError):
        R.rating_avg_by_gender(ratings, users, items, male="X", female="x")


def test_many_age_bounds(spark):
    users = spark.createDataFrame([("a", "M", 300.0), ("b", "F", 3.0), ("c", "F", -1.0)], USERS)
    got = {r.user_id: r.age_group for r in R.age_groups(users, list(range(0, 300, 2))).collect()}
    assert got == {"a": 149, "b": 1, "c": None}


def test_a_null_average_never_wins(spark):
    ratings = spark.createDataFrame([("1", "a", None), ("1", "b", 3.0)], "user_id string, item_id string, rating double")
    items = spark.createDataFrame([("b", "B")], "item_id string, title string")
    assert rows(R.best_rated_item(ratings, items, min_count=0)) == [("b", "B", 3.0, 1)]


def test_a_repeated_user_counts_once(spark):
    ratings = spark.createDataFrame([("1", "a", 1.0), ("2", "a", 4.0)], "user_id string, item_id string, rating double")
    users = spark.createDataFrame([("1", "M", 20), ("1", "M", 20), ("2", "M", 30)], "user_id string, gender string, age int")
    items = spark.createDataFrame([], "item_id string, title string")
    assert rows(R.rating_avg_by_gender(ratings, users, items), "male_avg") == [(2.5,)]
    assert rows(R.rating_avg_by_age_group(ratings, users, items), "avg_18_35") == [(2.5,)]
