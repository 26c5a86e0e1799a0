"""Connected components against union-find, and that a hot node is not one task's work."""

import random

import pytest
from pyspark.sql import functions as F

from anchorctx.llm.common import connected_components


def expected(edges):
    parent = {}

    def root(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in edges:
        if a is not None and b is not None and a != b:
            high, low = max(root(a), root(b)), min(root(a), root(b))
            parent[high] = low
    return {x: root(x) for x in parent}


@pytest.mark.parametrize("kind", ["random", "chain", "star", "odd"])
def test_components(spark, kind):
    chance = random.Random(6)
    edges = {
        "random": [(chance.randrange(400), chance.randrange(400)) for _ in range(260)],
        "chain": [(i, i + 1) for i in range(150)],
        "star": [(0, i) for i in range(500)] + [(500 - i, i) for i in range(90)],
        "odd": [(1, 1), (None, 2), (3, None), (-5, 7), (7, -5), (7, 9), (9, 7)],
    }[kind]
    table = spark.createDataFrame(edges, "a bigint, b bigint")
    got = {r["node"]: r["component"] for r in connected_components(table, "test").collect()}
    assert got == expected(edges)


def test_no_edges(spark):
    assert connected_components(spark.createDataFrame([], "a bigint, b bigint"), "test").count() == 0


SKEW = {
    "spark.sql.shuffle.partitions": "8",
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256k",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "256k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
}


def test_joins_split_a_node_with_most_of_the_edges(spark, monkeypatch):
    """80 % of the edges are one node's: the joins of its edges with the least nodes are split."""
    from anchorctx.llm import common

    plans = []
    saved = common.saved

    def seen(df, purpose):
        found = saved(df, purpose)
        if purpose.endswith(("-large", "-edges")):
            df.collect()
            plans.append((purpose, df._jdf.queryExecution().executedPlan().toString()))
        return found

    before = {name: spark.conf.get(name, None) for name in SKEW}
    try:
        for name, value in SKEW.items():
            spark.conf.set(name, value)
        monkeypatch.setattr(common, "saved", seen)
        n = 400_000
        edges = spark.range(n).select(
            F.when(F.col("id") % 5 > 0, 0).otherwise(F.col("id") - 4).alias("a"), F.col("id").alias("b")
        )
        got = connected_components(edges, "hot")
        # Node -4 comes with the first row.
        assert got.agg(F.countDistinct("node"), F.max("component")).first() == (n + 1, -4)
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)
    first = [plan for purpose, plan in plans if purpose == "hot-large"][0]
    assert "SortMergeJoin(skew=true)" in first

