"""Moving and removing result folders, on any file system that Arrow reaches."""

from __future__ import annotations

import pyarrow.fs as pafs
from pyspark.sql import SparkSession


def _qualified(spark: SparkSession, folder: str) -> str:
    """The folder's full address: a path without a scheme is on the session's default file system."""
    if "://" in folder or folder.startswith("file:"):
        return folder
    file = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder).select("path").first()
    return file.path[:file.path.rindex(folder.rstrip("/")) + len(folder.rstrip("/"))] if file else folder


def _reach(spark: SparkSession, folder: str) -> tuple[pafs.FileSystem, str]:
    address = _qualified(spark, folder).rstrip("/")
    if address.startswith("file:") and not address.startswith("file://"):
        address = "file://" + address.removeprefix("file:")
    return pafs.FileSystem.from_uri(address)


def remove_folder(spark: SparkSession, folder: str) -> None:
    """Removes a folder that this library wrote; nothing happens if it is gone."""
    fs, path = _reach(spark, folder)
    if fs.get_file_info(path).type == pafs.FileType.Directory:
        fs.delete_dir(path)


def move_into_place(spark: SparkSession, new: str, folder: str) -> None:
    """Puts the finished folder ``new``, beside ``folder``, in its place; what was there goes only then."""
    fs, source = _reach(spark, new)
    target = source.rsplit("/", 1)[0] + "/" + folder.rstrip("/").rsplit("/", 1)[-1]
    old = None
    if fs.get_file_info(target).type != pafs.FileType.NotFound:
        old = source + ".old"
        fs.move(target, old)
    try:
        fs.move(source, target)
    except Exception:
        if old:
            fs.move(old, target)
        raise
    if old:
        fs.delete_dir(old) if fs.get_file_info(old).type == pafs.FileType.Directory else fs.delete_file(old)
