"""Physical-plan checks: the shapes the operators are written to produce."""

import contextlib
import io

import pytest

from revlens.plans import catalog as E

SF_DIR = "/root/testdata/sf0.001"


def plan(df, mode="formatted"):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode)
    return buf.getvalue()


@pytest.mark.parametrize("name", sorted(E.queries()))
def test_no_python_in_plans(spark, name):
    text = plan(E.queries()[name](spark, SF_DIR))
    for node in ("BatchEvalPython", "ArrowEvalPython", "PythonUDF", "FlatMapGroupsInPandas",
                 "MapInPandas"):
        assert node not in text


def test_item_average_scan_is_pruned_and_filtered(spark):
    text = plan(E.queries()["rating_avg_by_item"](spark, SF_DIR))
    assert "ReadSchema: struct<l_partkey:bigint,l_quantity:double>" in text
    assert "orders.parquet" not in text          # users are not looked up here


def test_in_code_stop_list_is_a_scan_stage_filter(spark):
    text = plan(E.queries()["clean_words"](spark, SF_DIR))
    assert "LeftAnti" not in text
    assert "NOT word" in text and " IN (" in text


@pytest.fixture
def no_broadcasts(spark):
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    for k in keys:
        spark.conf.set(k, "-1")
    yield
    for k in keys:
        spark.conf.unset(k)


def test_stop_table_is_anti_joined(spark, no_broadcasts):
    df = E.queries()["word_freq_stop_table"](spark, SF_DIR)
    assert "LeftAnti" in plan(df)
    without = sorted(map(tuple, df.collect()))
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")
    assert without == sorted(map(tuple, E.queries()["word_freq_stop_table"](spark, SF_DIR).collect()))


def test_text_is_moved_once_at_most(spark, no_broadcasts):
    for name in E.queries():
        assert "RoundRobinPartitioning" not in plan(E.queries()[name](spark, SF_DIR))
    text = plan(E.queries()["clean_words"](spark, SF_DIR), "simple")
    assert text.count("Exchange hashpartitioning(rid") == 2      # documents and labels, for their join
    for name in ("word_freq_over", "word_count_by_category", "top5_related_words"):
        text = plan(E.queries()[name](spark, SF_DIR), "simple")
        assert "Exchange" not in text[text.rindex("partial_count"):]


def test_a_missing_column_raises(spark, tmp_path):
    from pyspark.errors import AnalysisException
    spark.read.parquet(f"{SF_DIR}/lineitem.parquet").drop("l_linestatus").write.parquet(str(tmp_path / "lineitem.parquet"))
    with pytest.raises(AnalysisException):
        E.queries()["ratings_union"](spark, str(tmp_path))


def test_stop_table_and_list_agree(spark):
    from revlens.operators import reviews as V
    from revlens.plans import bindings as B
    reviews = B.reviews(spark, SF_DIR)
    a = V.clean_words(reviews, V.stop_word_table(spark, B.STOP_WORDS), B.TOKEN_DELIMITERS)
    b = V.clean_words(reviews, B.STOP_WORDS, B.TOKEN_DELIMITERS)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_top_k_uses_partial_group_limit(spark):
    df = E.queries()["top5_related_words"](spark, SF_DIR)
    df.write.format("noop").mode("overwrite").save()
    text = plan(df)
    assert text.count("WindowGroupLimit") >= 2   # partial before, final after the shuffle


def test_aspect_winner_is_take_ordered(spark):
    text = plan(E.queries()["most_negative_aspect"](spark, SF_DIR))
    assert "TakeOrderedAndProject" in text


def test_genre_average_pre_aggregates_per_item(spark):
    text = plan(E.queries()["rating_avg_by_genre"](spark, SF_DIR), "simple")
    # the per-item (sum, count) aggregate sits below the genre join
    join_at = text.index("Join")
    assert "partial_sum(rating" in text[join_at:]


def test_sentiment_filter_reaches_labels_scan(spark):
    text = plan(E.queries()["top5_negative_words"](spark, SF_DIR))
    labels_scan = text[text.index("labels.parquet") - 400:]
    assert "toxic" in labels_scan


def test_sentiment_free_queries_skip_labels(spark):
    for name in ("word_freq_over", "top5_related_words", "count_by_category"):
        assert "labels.parquet" not in plan(E.queries()[name](spark, SF_DIR))
