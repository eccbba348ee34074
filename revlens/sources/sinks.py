"""Tab-separated text sinks.

Lines are written as ``col1<TAB>col2...`` with no quoting (a null prints as
an empty field), like the original outputs.  Writes go through Spark's
commit protocol, so a retried task never leaves partial files.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from revlens.sources.folders import move_into_place, remove_folder


def tsv_lines(df: DataFrame) -> DataFrame:
    """One ``value`` string per row, fields joined by tabs."""
    fields = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in df.columns]
    return df.select(F.concat_ws("\t", *fields).alias("value"))


def write_tsv(df: DataFrame, path: str, mode: str = "errorifexists",
              single_file: bool = False, order_by: Sequence[Column | str] | None = None,
              hidden: Sequence[str] = ()) -> None:
    """Write ``df`` as TSV text under ``path``.

    ``mode='errorifexists'`` refuses an existing folder.  ``'overwrite'``
    replaces it, all or nothing: lines are written beside it and moved into
    its place when all of them are there, so a failing job leaves the old
    result as it was.  ``single_file=True`` merges the output into one file; use it
    only for small results (the final write runs as one task).  Without an
    order it shuffles into one partition rather than ``coalesce(1)``, which
    would pull the whole upstream computation into that single task.

    ``order_by`` sorts the lines (range-partitioned sort; part files follow
    in order, and a single file keeps that order because ``coalesce(1)``
    stops at the sort's shuffle).  ``hidden`` columns may be used for the
    order but are not written.
    """
    if order_by:
        df = df.orderBy(*order_by)
    if hidden:
        df = df.drop(*hidden)
    lines = tsv_lines(df)
    if single_file:
        lines = lines.coalesce(1) if order_by else lines.repartition(1)
    if mode != "overwrite":
        lines.write.mode(mode).text(path)
        return
    if "://" not in path and not path.startswith(("/", "file:")):
        path = os.path.abspath(path)
    new = f"{path.rstrip('/')}.new-{uuid.uuid4().hex}"
    try:
        lines.write.mode("errorifexists").text(new)
    except Exception:
        remove_folder(df.sparkSession, new)
        raise
    move_into_place(df.sparkSession, new, path)
