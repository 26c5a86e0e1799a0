"""Scratch tables, text helpers and connected components shared by the operators."""

from __future__ import annotations

import os
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from anchorctx.sources.paths import scratch_folder


def saved(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` as a Parquet table in the shared scratch folder.

    What reads it depends on no earlier shuffle, so a lost executor costs only the
    tasks it was running; and it is computed once, however often it is read.
    """
    spark = df.sparkSession
    prepare(spark)
    path = scratch_folder(spark, purpose)
    df.write.parquet(path)
    found = spark.read.schema(df.schema).parquet(path)
    found.scratch_path = path
    return found


def discard(*tables: DataFrame) -> None:
    """Remove ``saved`` tables that nothing will read any more."""
    for table in tables:
        spark = table.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(table.scratch_path)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Shuffle files go with the query that made them, as later ones read its saved table."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def text_or_empty(text: str) -> Column:
    return F.coalesce(F.col(text), F.lit(""))


# What Spark sends to Python at a time, where the session has not chosen; texts may be long.
BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"
DEFAULT_BATCH, SMALL_BATCH = "67108864b", "8m"


def prepare(spark: SparkSession) -> None:
    """Small batches for Python workers, and the package on their path.

    They look for it where the driver has it, which serves local runs and shared folders;
    elsewhere the package is installed or sent with ``--py-files``.
    """
    if spark.conf.get(BATCH) == DEFAULT_BATCH:
        spark.conf.set(BATCH, SMALL_BATCH)
    root = str(Path(__file__).resolve().parents[2])
    environment = spark.sparkContext.environment
    paths = environment.get("PYTHONPATH", "").split(os.pathsep)
    if root not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([*filter(None, paths), root])


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def row_key(doc_id: str, text: str) -> Column:
    """The same for equal rows; 64 bits tell others apart."""
    return F.xxhash64(F.col(doc_id).cast("bigint"), F.col(text))


def unused(name: str, docs: DataFrame) -> str:
    """The name, or one like it that is no column of ``docs``."""
    taken = {column.lower() for column in docs.columns}
    while name in taken:
        name = "_" + name
    return name


def without_keys(docs: DataFrame, keys: DataFrame, doc_id: str, text: str) -> DataFrame:
    """``docs`` without the rows whose ``row_key`` is among ``keys``; columns of any names stay as they are."""
    name = unused("_row_key", docs)
    gone = keys.select(F.col("row_key").alias(name)).distinct()
    return docs.withColumn(name, row_key(doc_id, text)).join(gone, name, "left_anti").drop(name)


def held_out(doc_id: str, mod: int, remainder: int) -> Column:
    """Whether crc32 of the id as text leaves ``remainder``; false for a null id."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % mod == remainder, F.lit(False))


def connected_components(edges: DataFrame, purpose: str) -> DataFrame:
    """(node, component) for the nodes of ``edges`` (a, b); component is the least node reached.

    Alternating large-star and small-star steps: each replaces the edges of a node by
    edges to the least node it knows of, until every node has one edge, to the least
    of its component, which has none itself. Each round is a table in the scratch folder, and
    only whether another is needed reaches the driver. The rounds grow with the logarithm of the
    longest chain. Edges with a null end are ignored.

    The least nodes are tables of their own: a node with most of the edges is dealt to one task by
    its key, and Spark splits such a join only if neither side is an aggregate.
    """
    current = saved(
        edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct(),
        f"{purpose}-edges",
    )
    while True:
        both = current.unionByName(current.select(F.col("b").alias("a"), F.col("a").alias("b")))
        nearest = both.groupBy("a").agg(F.min("b").alias("_least"))
        nearest = saved(nearest.select("a", F.least("a", "_least").alias("_least")), f"{purpose}-least")
        large = (
            both.where("b > a").join(nearest, "a")
            .select(F.col("b").alias("a"), F.col("_least").alias("b"))
            .where("a <> b").distinct()
        )
        large = saved(large, f"{purpose}-large")
        least = saved(large.groupBy("a").agg(F.min("b").alias("_least")), f"{purpose}-least")
        small = (
            large.join(least, "a")
            .select(
                F.when(F.col("b") == F.col("_least"), F.col("a")).otherwise(F.col("b")).alias("a"),
                F.col("_least").alias("b"),
            )
            .where("a <> b").distinct()
        )
        older, current = current, saved(small, f"{purpose}-edges")
        discard(older, nearest, large, least)
        ends = current.select(
            F.col("a").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("head")
        ).unionByName(
            current.select(F.col("b").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("head"))
        )
        unfinished = (
            ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("head").alias("head"))
            .where("up > 1 or (up = 1 and head = 1)")
        )
        if unfinished.isEmpty():
            break
    heads = current.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return current.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(heads)
