"""Top-k per group and global top-1."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top_k_per_group(df: DataFrame, group_cols: Sequence[str], order: Sequence[Column],
                    k: int) -> DataFrame:
    """At most ``k`` rows per group, ordered by ``order`` (ties cut, not kept).

    ``row_number() <= k`` lets the optimizer insert a partial group limit
    before the shuffle, so each task sends at most ``k`` rows per group no
    matter how large or skewed a group is.
    """
    if k < 1:
        raise ValueError("k must be at least 1")
    w = Window.partitionBy(*group_cols).orderBy(*order)
    return (df.withColumn("_rank", F.row_number().over(w))
              .where(F.col("_rank") <= k)
              .drop("_rank"))


def top_one(df: DataFrame, order: Sequence[Column]) -> DataFrame:
    """The first row by ``order`` (a take-ordered, no global sort)."""
    return df.orderBy(*order).limit(1)
