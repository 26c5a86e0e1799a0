from collections import Counter
from zlib import crc32

import pytest
from pyspark.sql import functions as F
from tables import AWKWARD, docs, given

from anchorctx.llm.sharding import Splitters, shard_by_bytes


def check(rows, texts, shards):
    """Every row is there, slots have no gaps and shards differ by no more than a row."""
    expected = Counter(
        (d, len((t or "").encode()) + 8, crc32((t or "").encode())) for d, t in texts
    )
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in rows) == expected
    slots, sizes = {}, Counter()
    for r in rows:
        slots.setdefault(r.shard, []).append(r.slot)
        sizes[r.shard] += r.size
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert all(0 <= s < shards for s in slots)
    even, largest = sum(sizes.values()) / shards, max(r.size for r in rows)
    assert all(abs(sizes[s] - even) <= largest for s in range(shards))
    assert {(r.law, r.grown_shard) for r in rows} == {("bytes", None)}


@pytest.mark.parametrize("shards", [1, 3, 24])
def test_given_documents(spark, shards):
    table = given(spark)
    texts = [(r.doc_id, r.text) for r in table.collect()]
    check(shard_by_bytes(table, shards).collect(), texts, shards)


def test_awkward_rows(spark):
    check(shard_by_bytes(docs(spark, AWKWARD), 4).collect(), AWKWARD, 4)


def test_a_hot_text_and_a_hot_row_are_split(spark):
    rows = [(i, "hot") for i in range(600)] + [(7, "the same row")] * 600
    rows += [(10_000 + i, f"text {i}") for i in range(600)]
    found = shard_by_bytes(docs(spark, rows), 8).collect()
    check(found, rows, 8)


def test_equal_texts_are_neighbours(spark):
    rows = [(i, f"text {i % 40}") for i in range(400)]
    found = shard_by_bytes(docs(spark, rows), 4)
    spread = found.groupBy("text_crc32").agg(F.count_distinct("shard").alias("n"))
    assert spread.where("n > 1").count() <= 3


def test_empty_table(spark):
    found = shard_by_bytes(docs(spark, []))
    assert found.collect() == []
    assert [t for _, t in found.dtypes] == [
        "bigint", "bigint", "bigint", "string", "int", "bigint", "int"
    ]


def test_ranges_by_hand():
    import numpy as np

    splitters = Splitters([(5, 1), (5, 9), (7, 0), (-2, 3)])
    keys, subs = np.array([-3, -2, -2, 5, 5, 5, 6, 7]), np.array([0, 2, 3, 0, 1, 10, 0, 0])
    assert splitters.ranges(keys, subs).tolist() == [0, 0, 1, 1, 2, 3, 3, 4]
