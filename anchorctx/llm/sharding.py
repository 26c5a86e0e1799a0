"""Shards of near-equal bytes by sampled splitters."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from anchorctx.llm.common import documents, saved, text_or_empty

SCHEMA = (
    "doc_id bigint, size bigint, text_crc32 bigint, law string,"
    " shard int, slot bigint, grown_shard int"
)


class Splitters:
    """Sorted (key, sub) pairs; the range of a record is the number of pairs up to it."""

    def __init__(self, pairs):
        pairs = sorted(set(pairs))
        self.pairs = pairs
        self.keys = np.array([k for k, _ in pairs], dtype=np.int64)
        self.subs = np.array([s for _, s in pairs], dtype=np.int64)

    def ranges(self, keys: np.ndarray, subs: np.ndarray) -> np.ndarray:
        low = np.searchsorted(self.keys, keys, "left")
        high = np.searchsorted(self.keys, keys, "right")
        found = low.copy()
        hot = low < high
        for start in np.unique(low[hot]):
            here = hot & (low == start)
            end = high[here][0]
            found[here] = start + np.searchsorted(self.subs[start:end], subs[here], "right")
        return found

    def column(self):
        @F.pandas_udf("int")
        def of(key: pd.Series, sub: pd.Series) -> pd.Series:
            return pd.Series(self.ranges(key.to_numpy(), sub.to_numpy()).astype(np.int32))

        return of("_key", "_sub")


def _drawn(records: DataFrame, count: int) -> list[tuple]:
    """A sample of ``count`` records in which bytes weigh: the least of -ln(u) / bytes."""
    u = (F.pmod(F.xxhash64("_key", "_sub", F.lit("sample")), F.lit(1 << 52)) + 0.5) / float(1 << 52)
    return [
        (row[0], row[1], row[2])
        for row in records.withColumn("_priority", -F.log(u) / (F.col("size") * F.col("_copies")))
        .orderBy("_priority", "_key", "_sub")
        .limit(count)
        .select("_range", "_key", "_sub")
        .collect()
    ]


def _quantiles(sample: list[tuple], pieces: int) -> list[tuple]:
    sample = sorted(sample)
    return [sample[len(sample) * i // pieces] for i in range(1, pieces) if sample]


def shard_by_bytes(
    docs: DataFrame,
    shards: int = 24,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    ranges_per_shard: int = 16,
    samples_per_range: int = 32,
    overfull: float = 3.0,
) -> DataFrame:
    """Every row of ``docs`` in one of ``shards`` shards whose bytes differ by a row or so.

    The key of a record is the hash of its text, then of its id, so equal texts are
    neighbours. A size-weighted sample of keys gives the splitters of
    ``shards * ranges_per_shard`` ranges; a range that turns out to hold more than
    ``overfull`` times the mean, in bytes or in records, is split again by a sample of its own.
    Each range is put in order by itself, and the exact bytes before a record say
    which shard it starts in, so no sampling error is left in the sizes.

    The driver holds splitters and totals of ranges only, whose number these parameters fix;
    ``ranges_per_shard`` should give ranges that fit a task. Equal records of
    one input partition are one record with a count. Size is the UTF-8 bytes of the text
    plus 8. A null text counts as empty, null ids sort like any other. Repeated rows are placed
    one by one. An empty table gives an empty result. Other columns are not read.
    """
    spark = docs.sparkSession
    body = text_or_empty(text)
    records = saved(
        docs.select(
            F.col(doc_id).cast("bigint").alias("doc_id"),
            (F.octet_length(body) + F.lit(8)).cast("bigint").alias("size"),
            F.crc32(body.cast("binary")).alias("text_crc32"),
            F.xxhash64(body).alias("_key"),
            F.spark_partition_id().alias("_part"),
        )
        .groupBy("doc_id", "size", "text_crc32", "_key", "_part")
        .agg(F.count("*").alias("_copies"))
        .withColumn("_sub", F.xxhash64("doc_id", "_part")),
        "shard-records",
    )
    total, rows = records.agg(F.sum(F.col("size") * F.col("_copies")), F.count("*")).first()
    if not rows:
        return spark.createDataFrame([], SCHEMA)

    ranges = shards * ranges_per_shard
    sample = _drawn(records.withColumn("_range", F.lit(0)), ranges * samples_per_range)
    splitters = Splitters((k, s) for _, k, s in _quantiles(sample, ranges))
    limits = overfull * total / ranges, overfull * max(1.0, rows / ranges)
    while True:
        ranged = records.withColumn("_range", splitters.column())
        totals = {
            row["_range"]: row
            for row in ranged.groupBy("_range")
            .agg(
                F.sum(F.col("size") * F.col("_copies")).alias("bytes"),
                F.sum("_copies").alias("rows"),
                F.count("*").alias("records"),
            )
            .collect()
        }
        pieces = {
            r: int(overfull * max(row["bytes"] / limits[0], row["records"] / limits[1])) + 1
            for r, row in totals.items()
            if row["records"] > 1 and (row["bytes"] > limits[0] or row["records"] > limits[1])
        }
        if not pieces:
            break
        drawn = _drawn(
            ranged.where(F.col("_range").isin(list(pieces))),
            samples_per_range * sum(pieces.values()),
        )
        more = set(splitters.pairs)
        for r, count in pieces.items():
            more.update((k, s) for _, k, s in _quantiles([x for x in drawn if x[0] == r], count))
        if len(more) == len(splitters.pairs):
            break
        splitters = Splitters(more)

    starts, byte, row_number = [], 0, 0
    for r in sorted(totals):
        starts.append((r, byte, row_number))
        byte, row_number = byte + totals[r]["bytes"], row_number + totals[r]["rows"]
    starts = spark.createDataFrame(starts, "_range int, _bytes bigint, _rows bigint")
    before = (
        Window.partitionBy("_range")
        .orderBy("_key", "_sub", "doc_id", "size", "text_crc32", "_part")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    placed = (
        ranged.withColumns(
            {
                "_bytes_before": F.coalesce(
                    F.sum(F.col("size") * F.col("_copies")).over(before), F.lit(0)
                ),
                "_rows_before": F.coalesce(F.sum("_copies").over(before), F.lit(0)),
            }
        )
        .join(F.broadcast(starts), "_range")
        .withColumn("_copy", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("_copies") - 1)))
        .withColumn("_at", F.col("_bytes") + F.col("_bytes_before") + F.col("_copy") * F.col("size"))
        .select(
            "doc_id",
            "size",
            "text_crc32",
            F.expr(f"cast(cast(_at as decimal(38,0)) * {shards} div {total} as int)").alias("shard"),
            (F.col("_rows") + F.col("_rows_before") + F.col("_copy")).alias("_row"),
        )
    )
    placed = saved(placed, "shard-placed")
    first = dict(placed.groupBy("shard").agg(F.min("_row")).collect())
    first_row = F.create_map([F.lit(x) for item in first.items() for x in item])[F.col("shard")]
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        (F.col("_row") - first_row).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op1_shards(spark, sf_dir):
    return shard_by_bytes(documents(spark, sf_dir))
