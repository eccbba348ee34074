import pytest

from revlens.functions.text import DEFAULT_TOKEN_DELIMITERS
from revlens.operators import reviews as V
from tests.conftest import rows

REVIEWS = "rid int, review string, category string, aspect string, sentiment string"


@pytest.fixture()
def reviews(spark):
    return spark.createDataFrame([
        (1, "Phòng đẹp, sạch (rất) *tốt*", "general", "rooms", "Positive"),
        (1, "Phòng đẹp, sạch (rất) *tốt*", "GENERAL", "HOTEL", "positive"),
        (2, "Nhân viên THE tệ. tệ", "PRICES", "service", "NEGATIVE"),
        (None, "đẹp đẹp", "PRICES", "hotel", "neutral"),
        (3, '  "  ', "PRICES", "rooms", "negative"),
    ], REVIEWS)


@pytest.fixture()
def stops(spark):
    return V.stop_word_table(spark, ["rất", "the", "The", "rất"])


def test_normalize_cases(spark, reviews):
    out = rows(V.normalize(reviews), "category", "aspect", "sentiment")
    assert ("GENERAL", "ROOMS", "positive") in out
    assert ("PRICES", "SERVICE", "negative") in out


def test_clean_words(spark, reviews, stops):
    words = V.clean_words(reviews, stops, DEFAULT_TOKEN_DELIMITERS)
    got = [w for (w,) in rows(words.where("rid = 2"), "word")]
    # stop list is matched as is against lower-cased tokens; "tệ." keeps its dot
    assert got == sorted(["nhân", "viên", "tệ.", "tệ"])
    assert [w for (w,) in rows(words.where("rid = 1 and aspect = 'ROOMS'"), "word")] == \
        sorted(["phòng", "đẹp", "sạch", "tốt"])
    assert words.where("rid = 3").count() == 0   # only delimiters and spaces
    assert words.where("rid is null").count() == 2


def test_word_freq_strict_threshold_and_null_rid(spark, reviews, stops):
    words = V.clean_words(reviews, stops)
    # đẹp: 2 rows with rid 1 + 2 rows with null rid -> counted 2
    assert rows(V.word_freq_over(words, 1), "word", "freq") == [
        ("phòng", 2), ("sạch", 2), ("tốt", 2), ("đẹp", 2)]
    assert V.word_freq_over(words, 2).count() == 0


def test_comment_counts_raw_case_and_distinct(spark, reviews):
    out = rows(V.comment_counts(reviews, "category"))
    assert out == [("GENERAL", 1, 1), ("PRICES", 2, 2), ("general", 1, 1)]
    only_null = reviews.where("rid is null")
    assert rows(V.comment_counts(only_null, "aspect")) == [("hotel", 0, 0)]


def test_most_judged_aspect_tie_goes_to_smaller_name(spark):
    df = spark.createDataFrame([
        (1, "", "c", "rooms", "negative"), (2, "", "c", "ROOMS", "negative"),
        (3, "", "c", "hotel", "negative"), (4, "", "c", "Hotel", "Negative"),
        (5, "", "c", "food", "positive")], REVIEWS)
    assert rows(V.most_judged_aspect(df, "negative", "neg_count")) == [("HOTEL", 2)]
    assert rows(V.most_judged_aspect(df, "positive", "pos_count")) == [("FOOD", 1)]


def test_top_words_ties_cut_at_k(spark):
    counts = spark.createDataFrame([
        ("A", "positive", "mưa", 12), ("A", "positive", "gió", 12), ("A", "positive", "z", 14),
        ("A", "positive", "b", 3), ("A", "negative", "q", 99), ("B", "positive", "x", 1)],
        "category string, sentiment string, word string, cnt long")
    top2 = rows(V.top_words(counts, 2, "positive"))
    assert top2 == [("A", "gió", 12), ("A", "z", 14), ("B", "x", 1)]
    assert V.top_words(counts, 5).where("category = 'A'").count() == 5


def test_token_kept_untrimmed_after_blank_test(spark):
    df = spark.createDataFrame([(1, "\x01ab\x02 \x03 ok", "c", "a", "positive")], REVIEWS)
    words = [w for (w,) in rows(V.clean_words(df, []), "word")]
    assert words == sorted(["\x01ab\x02", "ok"])


def test_null_keys_form_one_group(spark):
    df = spark.createDataFrame([(1, "x", None, "a", "p"), (2, "y", None, "a", "p"),
                                (2, "z", "C", "a", "p")], REVIEWS)
    assert rows(V.comment_counts(df, "category")) == [("C", 1, 1), (None, 2, 2)]


def test_null_aspect_is_the_smallest_name_in_ties(spark):
    df = spark.createDataFrame([(1, "", "c", None, "negative"), (2, "", "c", "b", "negative")],
                               REVIEWS)
    assert rows(V.most_judged_aspect(df, "negative", "neg_count")) == [(None, 1)]
