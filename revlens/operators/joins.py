"""Join helpers.

Large tables are joined without hints: the optimizer broadcasts a side
only when its estimated size is under ``spark.sql.autoBroadcastJoinThreshold``
and AQE re-checks with runtime sizes, falling back to a shuffled join and
splitting skewed partitions.  An explicit broadcast is used only for a side
that is small by construction.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


#: The column of readers that carry line order; where a table has it, the last line of a repeated key wins.
ORDER = "line_order"


def last_value(df: DataFrame, value: Column | str) -> Column:
    """Of a key's rows, the last line's value; the largest where the table has no line order."""
    return F.max_by(value, F.col(ORDER)) if ORDER in df.columns else F.max(value)


def lookup_with_fallback(facts: DataFrame, dim: DataFrame, key: str, value: str) -> DataFrame:
    """Left join ``value`` by ``key``; a missing value falls back to the key text.

    ``facts`` must hold one row per key (an aggregate).  The raw ``dim`` is
    joined first and a repeated key is reduced afterwards (the last line wins
    if ``dim`` has ``line_order``, else the largest value): the join's output
    is already partitioned and sorted by the key, so that reduction needs no
    shuffle and no sort, and ``dim`` is shuffled once with no aggregate of its
    own.
    """
    joined = facts.join(dim.select(key, value, *[c for c in dim.columns if c == ORDER]), key, "left")
    others = [c for c in facts.columns if c != key]
    reduced = joined.groupBy(key).agg(*[F.any_value(c).alias(c) for c in others],
                                      last_value(joined, value).alias(value))
    return reduced.withColumn(value, F.coalesce(F.col(value), F.col(key).cast("string")))
