"""Helpers shared by the training-data operators: tables, stored intermediates, text batches."""

from __future__ import annotations

import ctypes
import os
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from ..session import ensure_checkpoint_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder named by ``spark.checkpoint.dir``."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stash(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back.

    Cuts the lineage: a lost executor costs the tasks it ran, not a second
    run of what is stored.  The folder lives as long as the shared folder does.
    """
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Rows of an Arrow batch, where the session has the default: texts are long, and two batches are held at once.
BATCH_ROWS = 1000


def text_slices(texts: list[str | None], max_chars: int = 1_500_000) -> Iterator[tuple[int, list[str]]]:
    """Consecutive slices ``(first, texts)`` of at most ``max_chars`` (a longer text is alone); null reads as ''."""
    first, size, part = 0, 0, []
    for i, text in enumerate(texts):
        text = text or ""
        if part and size + len(text) > max_chars:
            yield first, part
            first, size, part = i, 0, []
        part.append(text)
        size += len(text)
    if part:
        yield first, part


def workers_import(spark: SparkSession) -> None:
    """Lets Python workers started from here on import this package from where the driver has it.

    Where executors have no such folder, ship the package with ``--py-files``.
    """
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        env["PYTHONPATH"] = os.pathsep.join([*paths, root])


#: What an operator keeps in a worker for its next tasks, by name, and the operator's module.
KEPT: dict[str, object] = {}
_owner: str | None = None


def begin_task(owner: str) -> None:
    """A worker outlives its stages: what another operator kept in it goes."""
    global _owner
    if owner != _owner:
        KEPT.clear()
        _owner = owner


def give_back() -> None:
    """Gives the memory that a task has freed back to the system, for the other processes of the executor."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it
    if trim:
        trim(0)


def arrow_map(df: DataFrame, fn: Callable, schema: str | StructType) -> DataFrame:
    """``df.mapInArrow`` with this package importable on the workers and batches of ``BATCH_ROWS`` rows.

    A task gives its memory back when it ends, as workers live on.
    """
    owner = fn.__module__

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begin_task(owner)
        yield from fn(batches)
        give_back()

    workers_import(df.sparkSession)
    rows = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if df.sparkSession.conf.get(rows) == "10000":
        df.sparkSession.conf.set(rows, BATCH_ROWS)
    return df.mapInArrow(run, schema)
