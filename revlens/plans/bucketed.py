"""Bucketed copies of the input tables, for repeated runs over the same data.

Joining documents to their labels by id shuffles the document text once per
run, and joining ratings to their orders shuffles the ratings.  Written once
bucketed (and sorted) by the join key with the same bucket count, the big
tables keep their stored partitioning: the documents-labels join needs no
exchange at all, and in the ratings-users join only the orders-sized side is
shuffled to match the lineitem buckets.  The tables are written at an
explicit location (an external table), so no warehouse setting is needed;
the session's catalog records them.

Choose a bucket count of at least ``spark.sql.shuffle.partitions``: Spark
keeps a bucketed side unshuffled (and shuffles the other side to match it)
only when its bucket count is not below that setting.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from revlens.plans import bindings as B

DOC_COLUMNS = ("doc_id", "text", "source", "lang")
LABEL_COLUMNS = ("doc_id", "quality", "toxic")
LINEITEM_COLUMNS = ("l_orderkey", "l_partkey", "l_quantity", "l_linestatus")
ORDER_COLUMNS = ("o_orderkey", "o_custkey")


def write_bucketed(df: DataFrame, table: str, key: str, buckets: int, path: str,
                   mode: str = "overwrite") -> None:
    """Save ``df`` as table ``table`` at ``path``, bucketed and sorted by ``key``."""
    (df.write.mode(mode).bucketBy(buckets, key).sortBy(key)
       .option("path", path).saveAsTable(table))


def bucket_review_tables(spark: SparkSession, sf_dir: str, buckets: int, base_path: str,
                         documents_table: str = "revlens_documents",
                         labels_table: str = "revlens_labels") -> tuple[str, str]:
    """Write bucketed copies of ``documents`` and ``labels``; returns the table names."""
    write_bucketed(B.table(spark, sf_dir, "documents").select(*DOC_COLUMNS), documents_table,
                   "doc_id", buckets, f"{base_path}/{documents_table}")
    write_bucketed(B.table(spark, sf_dir, "labels").select(*LABEL_COLUMNS), labels_table,
                   "doc_id", buckets, f"{base_path}/{labels_table}")
    return documents_table, labels_table


def bucketed_reviews(spark: SparkSession, documents_table: str = "revlens_documents",
                     labels_table: str | None = "revlens_labels") -> DataFrame:
    """The reviews binding over the bucketed tables (shuffle-free labels join)."""
    labels = spark.table(labels_table) if labels_table else None
    return B.reviews_from(spark.table(documents_table), labels)


def bucket_rating_tables(spark: SparkSession, sf_dir: str, buckets: int, base_path: str,
                         lineitem_table: str = "revlens_lineitem",
                         orders_table: str = "revlens_orders") -> tuple[str, str]:
    """Write ``lineitem`` and ``orders`` bucketed by order key; returns the table names."""
    write_bucketed(B.table(spark, sf_dir, "lineitem").select(*LINEITEM_COLUMNS),
                   lineitem_table, "l_orderkey", buckets, f"{base_path}/{lineitem_table}")
    write_bucketed(B.table(spark, sf_dir, "orders").select(*ORDER_COLUMNS),
                   orders_table, "o_orderkey", buckets, f"{base_path}/{orders_table}")
    return lineitem_table, orders_table


def bucketed_rated_by_known_users(spark: SparkSession, sf_dir: str, *user_cols: str,
                                  lineitem_table: str = "revlens_lineitem",
                                  orders_table: str = "revlens_orders") -> DataFrame:
    """Ratings with user attributes, reading lineitem and orders from their buckets."""
    return B.rated_by_known_users_from(spark.table(lineitem_table), spark.table(orders_table),
                                       B.table(spark, sf_dir, "customer"), *user_cols)
