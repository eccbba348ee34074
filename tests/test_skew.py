"""A key holding a third of all rows: results stay exact and the hot join
partition is split at runtime instead of landing in one task."""

from collections import defaultdict

import pytest

from revlens.operators import ratings as R
from revlens.operators import reviews as V

SKEW_CONF = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
}


@pytest.fixture()
def skew_conf(spark):
    old = {k: spark.conf.get(k, None) for k in SKEW_CONF}
    for k, v in SKEW_CONF.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)


def _data(n=9000):
    ratings = []
    for i in range(n):
        item = "hot" if i % 3 == 0 else f"i{i % 97}"
        ratings.append((f"u{i % 50}", item, float(i % 5 + 1)))
    items = [("hot", "Hot", "A|B")] + [(f"i{j}", f"T{j}", "B|C" if j % 2 else "C")
                                       for j in range(97)]
    return ratings, items


def _final_plan(df):
    """The adaptive plan as executed by an action on ``df`` itself."""
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_hot_item_genre_join(spark, skew_conf):
    ratings_rows, item_rows = _data()
    ratings = spark.createDataFrame(ratings_rows, "user_id string, item_id string, rating double")
    items = spark.createDataFrame(item_rows, "item_id string, title string, genres string")
    genres = R.explode_genres(items)
    pairs = R.genre_rating_pairs(ratings, genres)
    assert "skew=true" in _final_plan(pairs)

    genre_of = {i: g.split("|") for i, _, g in item_rows}
    want = defaultdict(lambda: [0.0, 0])
    for _, item, r in ratings_rows:
        for g in genre_of[item]:
            want[g][0] += r
            want[g][1] += 1
    got = {g: n for g, n in pairs.groupBy("genre").count().collect()}
    assert got == {g: n for g, (_, n) in want.items()}
    avg = {g: (a, n) for g, a, n in R.rating_avg_by_genre(ratings, genres).collect()}
    assert avg == {g: pytest.approx((s / n, n)) for g, (s, n) in want.items()}


def test_hot_category_top_words(spark, skew_conf):
    rows = [(i, ("hot word " * (i % 4 + 1)) + f"w{i % 13}", "HOT" if i % 3 else f"C{i % 7}",
             "a", "positive") for i in range(3000)]
    reviews = spark.createDataFrame(
        rows, "rid int, review string, category string, aspect string, sentiment string")
    stop = V.stop_word_table(spark, ["word"])
    counts = V.word_counts(V.clean_words(reviews, stop), ["category"])
    top = {(c, w): n for c, w, n in V.top_words(counts, 2).collect()}
    want = defaultdict(int)
    for rid, text, cat, _, _ in rows:
        for w in text.split():
            if w != "word":
                want[(cat, w)] += 1
    for cat in {c for c, _ in want}:
        ranked = sorted(((-n, w) for (c, w), n in want.items() if c == cat))[:2]
        for n, w in ranked:
            assert top[(cat, w)] == -n
    assert len(top) == 2 * len({c for c, _ in want})


