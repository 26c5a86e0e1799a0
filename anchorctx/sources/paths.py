"""Folders that all executors see."""

from __future__ import annotations

import uuid
from urllib.parse import urlparse

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def scratch_folder(spark: SparkSession, purpose: str) -> str:
    """A new folder name in the shared folder that ``spark.checkpoint.dir`` names.

    Where that is unset, in the warehouse folder. On a cluster this has to be a folder that all
    executors see; a folder of one machine raises ValueError.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        warehouse = spark.conf.get("spark.sql.warehouse.dir")
        if urlparse(warehouse).scheme in ("", "file") and not spark.sparkContext.master.startswith(
            "local"
        ):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors see")
        shared = f"{warehouse.rstrip('/')}/_scratch"
    return f"{shared.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def file_system(spark: SparkSession, path: str):
    """The Hadoop file system that holds ``path``, and a function that names paths to it."""
    named = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    return named(path).getFileSystem(spark._jsc.hadoopConfiguration()), named


def remove(spark: SparkSession, path: str) -> None:
    """Remove a folder, if it is there, with all that is in it."""
    files, named = file_system(spark, path)
    files.delete(named(path), True)


def publish(spark: SparkSession, new: str, path: str) -> None:
    """Give the folder ``new`` the name ``path``; what has that name is removed last.

    Both lie in one file system. Should the folder not get its name, the old one gets its own back.
    """
    files, named = file_system(spark, path)

    def renamed(one: str, other: str) -> bool:
        try:
            return files.rename(named(one), named(other))
        except Py4JJavaError:
            return False

    old = f"{new}-replaced"
    replaces = files.exists(named(path))
    if replaces and not renamed(path, old):
        raise OSError(f"cannot rename {path}")
    if not renamed(new, path):
        if replaces:
            renamed(old, path)
        raise OSError(f"cannot rename {new} to {path}")
    if replaces:
        files.delete(named(old), True)
