"""The whole-lab report plans on the driver tables give the same lines as the
registered (oracle-checked) queries, though they take other paths: shared
pre-aggregates written to the checkpoint folder, another join order, sums
over the shared word counts."""

import os

import pytest

import __spark_entry__ as E
from revlens.plans import bindings as B
from revlens.plans.report import ratings_report, reviews_report

SF_DIR = "/root/testdata/sf0.001"


def lines(path):
    out = []
    for name in sorted(os.listdir(path)):
        if name.startswith("part-"):
            with open(os.path.join(path, name), encoding="utf-8") as fh:
                out.extend(fh.read().splitlines())
    return sorted(out)


def query_lines(spark, name, cols=None):
    df = E.queries()[name](spark, SF_DIR)
    if cols:
        df = df.select(*cols)
    return sorted("\t".join("" if v is None else str(v) for v in r) for r in df.collect())


@pytest.fixture(scope="module")
def rating_paths(spark, tmp_path_factory):
    out = str(tmp_path_factory.mktemp("ratings_report"))
    return ratings_report(B.ratings_with_user(spark, SF_DIR), B.items(spark, SF_DIR),
                          B.users(spark, SF_DIR), out, min_count=B.TOP_ITEM_MIN_COUNT,
                          age_bounds=B.AGE_BOUNDS, genre_separator=B.ITEM_GENRE_SEPARATOR)


@pytest.fixture(scope="module")
def review_paths(spark, tmp_path_factory):
    out = str(tmp_path_factory.mktemp("reviews_report"))
    return reviews_report(B.reviews(spark, SF_DIR), B.STOP_WORDS, out,
                          threshold=B.WORD_FREQ_THRESHOLD, k=B.TOP_K,
                          delimiters=B.TOKEN_DELIMITERS,
                          judgements=B.conversation_judgements(spark, SF_DIR))


@pytest.mark.parametrize("output,query", [
    ("item_averages", "item_report_lines"),
    ("genre_averages", "genre_report_lines"),
    ("gender_averages", "gender_report_lines"),
    ("age_group_averages", "age_group_report_lines"),
    ("genre_rating_pairs", "genre_rating_pairs"),
])
def test_ratings_report_matches_queries(spark, rating_paths, output, query):
    assert lines(rating_paths[output]) == query_lines(spark, query)


@pytest.mark.parametrize("output,query,cols", [
    ("words", "clean_words", None),
    ("word_freq_over", "word_freq_over", None),
    ("count_by_category", "count_by_category", None),
    ("count_by_aspect", "count_by_aspect", None),
    ("most_negative_aspect", "most_negative_aspect", None),
    ("most_positive_aspect", "most_positive_aspect", None),
    ("top_positive_words", "top5_positive_words", None),
    ("top_negative_words", "top5_negative_words", None),
    ("top_related_words", "top5_related_words", None),
])
def test_reviews_report_matches_queries(spark, review_paths, output, query, cols):
    assert lines(review_paths[output]) == query_lines(spark, query, cols)
