import re

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from revlens.functions import fmt
from revlens.functions.text import (
                                    has_visible_char, java_split, java_trim)


def one(spark, value, expr_fn, schema="s string"):
    df = spark.createDataFrame([(value,)], schema)
    return df.select(expr_fn(F.col("s")).alias("x")).first()["x"]


def test_java_trim_strips_control_chars(spark):
    assert one(spark, "\t\x01 a b \x1f\n", java_trim) == "a b"
    assert one(spark, "\x00 \x10", java_trim) == ""
    assert one(spark, " x ", java_trim) == " x "


def test_has_visible_char(spark):
    assert one(spark, " \x01\t", has_visible_char) is False
    assert one(spark, " é ", has_visible_char) is True
    assert one(spark, None, has_visible_char) is None


def test_java_split_trailing_empties(spark):
    sp = lambda c: java_split(c, r",\s*")
    assert one(spark, "1,2,", sp) == ["1", "2"]
    assert one(spark, "1, 2, ,", sp) == ["1", "2"]
    assert one(spark, "1,2,,9", sp) == ["1", "2", "", "9"]
    assert one(spark, ",1,2", sp) == ["", "1", "2"]
    assert one(spark, "", sp) == [""]
    assert one(spark, ",,", sp) == []
    assert one(spark, "abc", sp) == ["abc"]


def test_java_split_final_line_terminator(spark):
    sp = lambda c: java_split(c, r"\|")
    assert one(spark, "a|b|\n", sp) == ["a", "b", "\n"]
    assert one(spark, "a|b|\u2028", sp) == ["a", "b", "\u2028"]
    assert one(spark, "a|b|", sp) == ["a", "b"]


def test_java_split_with_limit_keeps_rest(spark):
    sp = lambda c: java_split(c, r",\s*", 3)
    assert one(spark, "5, Heat, Action|Crime, x", sp) == ["5", "Heat", "Action|Crime, x"]
    assert one(spark, "5, Heat,", sp) == ["5", "Heat", ""]


def _java_split_model(s: str, pattern: str) -> list[str]:
    parts = re.split(pattern, s)
    if len(parts) == 1:
        return parts
    while parts and parts[-1] == "":
        parts.pop()
    return parts


@settings(max_examples=40, deadline=None)
@given(st.lists(st.text(alphabet="ab, |", max_size=8), min_size=1, max_size=12))
def test_java_split_matches_java_rules(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "s string")
    for pattern in (r",\s*", r"\|"):
        got = [r["x"] for r in df.select(java_split("s", pattern).alias("x")).collect()]
        assert got == [_java_split_model(v, pattern) for v in values]


def test_fixed_two_decimals_round_half_up(spark):
    # 3.775 is stored just below; Java's formatter still prints 3.78.
    assert one(spark, 3.775, lambda c: F.format_string("%.2f", c), "s double") == "3.78"
    df = spark.createDataFrame([(4.25, 2)], "a double, n long")
    assert df.select(fmt.item_line("a", "n")).first()[0] == "4.25 (TotalRatings: 2)"


def test_top_item_line_fallback(spark):
    df = spark.createDataFrame([(None, None)], "t string, a double")
    assert df.select(fmt.top_item_line("t", "a", 5)).first()[0] == \
        "No movie has at least 5 ratings."
    df = spark.createDataFrame([("Heat", 4.5)], "t string, a double")
    assert df.select(fmt.top_item_line("t", "a", 5)).first()[0] == "Heat (Average: 4.50)"


def test_bucket_line_prints_empty_as_zero(spark):
    df = spark.createDataFrame([(4.0, None)], "a double, b double")
    assert df.select(fmt.bucket_line(["0-18", "18+"], ["a", "b"])).first()[0] == \
        "[0-18: 4.00, 18+: 0.00]"
