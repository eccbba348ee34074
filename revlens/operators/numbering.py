"""Running numbers over a whole table, without a task that sees all of it."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from revlens.session import ensure_checkpoint_dir

_WITHIN = (1 << 33) - 1  # monotonically_increasing_id: the row within its partition


def numbered(df: DataFrame, order: Sequence[Column | str], name: str = "line", start: int = 1) -> DataFrame:
    """``df`` with ``name``, its rows' running number in the order of ``order``.

    Rows are range-partitioned and sorted, and stored with their place within
    the partition, so that a lost task can't number them anew; each partition
    then only needs the number of rows before it, which one row a partition
    gives.  ``order`` should be total: rows equal in it stay in one partition
    and are numbered in any order.  The stored rows stay under
    ``spark.checkpoint.dir`` for as long as the result is read.
    """
    if {name, "_part", "_at"} & set(df.columns):
        raise ValueError(f"the table already has one of the columns {name}, _part, _at")
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/numbered-{uuid.uuid4().hex}"
    placed = df.repartitionByRange(*order).sortWithinPartitions(*order)
    (placed.withColumn("_part", F.spark_partition_id())
     .withColumn("_at", F.monotonically_increasing_id().bitwiseAND(F.lit(_WITHIN))).write.parquet(path))
    stored = spark.read.parquet(path)
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # over one row a partition
    offsets = (stored.groupBy("_part").agg(F.count("*").alias("n"))
               .select("_part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_before")))
    number = (F.col("_before") + F.col("_at") + F.lit(start)).cast("long").alias(name)
    return stored.join(offsets, "_part").select(number, *df.columns)
