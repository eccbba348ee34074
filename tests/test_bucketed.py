import contextlib
import io

from revlens.operators import reviews as V
from revlens.plans import bindings as B
from revlens.plans.bucketed import bucket_review_tables, bucketed_reviews

SF_DIR = "/root/testdata/sf0.001"


def test_bucketed_labels_join_needs_no_exchange(spark, tmp_path):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        docs_t, labels_t = bucket_review_tables(spark, SF_DIR, 4, str(tmp_path),
                                                "t_docs", "t_labels")
        rv = bucketed_reviews(spark, docs_t, labels_t)
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            rv.explain()
        plan = buf.getvalue()
        assert "SortMergeJoin" in plan and "Exchange" not in plan
        plain = B.reviews(spark, SF_DIR)
        assert rv.exceptAll(plain).count() == 0 and plain.exceptAll(rv).count() == 0
        a = V.word_counts(V.clean_words(rv, B.STOP_WORDS, B.TOKEN_DELIMITERS),
                          ["category", "sentiment"])
        b = V.word_counts(V.clean_words(plain, B.STOP_WORDS, B.TOKEN_DELIMITERS),
                          ["category", "sentiment"])
        assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_bucketed_lineitem_is_never_shuffled(spark, tmp_path):
    from revlens.operators import ratings as R
    from revlens.plans.bucketed import bucket_rating_tables, bucketed_rated_by_known_users
    old = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold",
                                          "spark.sql.adaptive.enabled")}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        li_t, ord_t = bucket_rating_tables(spark, SF_DIR, 8, str(tmp_path), "t_li", "t_ord")
        rated = bucketed_rated_by_known_users(spark, SF_DIR, "gender_side",
                                              lineitem_table=li_t, orders_table=ord_t)
        stats = R.gender_averages(rated)
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            stats.explain()
        plan = buf.getvalue()
        # lineitem is read bucket by bucket and meets the orders-users side
        # without an exchange; the four exchanges move orders, customers,
        # the joined orders-users rows and the per-item partial aggregates
        scan = next(ln for ln in plan.splitlines() if "t_li" in ln and "FileScan" in ln)
        assert "Bucketed: true" in scan
        assert plan.count("Exchange hashpartitioning") == 4
        assert "hashpartitioning(order_key" in plan and "hashpartitioning(item_id" in plan
        plain = R.gender_averages(B.rated_by_known_users(spark, SF_DIR, "gender_side"))
        assert stats.exceptAll(plain).count() == 0 and plain.exceptAll(stats).count() == 0
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
