"""Documents to training tokens: toxic texts, repeated lines, copies and benchmark leaks go.

Every filtering stage returns the columns it got, whatever their names. Null and empty texts and null ids are
rows like any other: they are scored as empty texts, have no lines, and have fingerprint zero, so one row of them
stays, that of the least id. Rows equal in id and text are treated alike up to SimHash near-dedup,
which keeps one. Ties go to the least id, then to the least hash of the text. An empty table gives an
empty one, and empty labels or an empty benchmark take nothing away.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from anchorctx.llm.bpe import digests
from anchorctx.llm.common import discard, documents, saved
from anchorctx.llm.decontaminate import decontaminate
from anchorctx.llm.line_dedup import dedup_lines
from anchorctx.llm.simhash import one_of_each_group
from anchorctx.llm.toxicity import without_toxic


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the rows that the model trained on the labels predicts to be toxic."""
    return without_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows, with the first line of each component of near-equal lines left in their texts."""
    return dedup_lines(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of fingerprints four bits apart or less."""
    return one_of_each_group(docs, shingle_words=4, max_bits=4)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the rows in which ten consecutive words, or all of a shorter item, are of the benchmark."""
    return decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' ids with their count and digests."""
    return digests(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), keep_ids=True)


STAGES = [
    ("toxicity", drop_toxic),
    ("line dedup", drop_repeated_lines),
    ("SimHash near-dedup", drop_near_copies),
    ("benchmark decontamination", drop_benchmark_leaks),
    ("byte-level BPE encoding and decoding", encode),
]

# Trained trees, bands of hashes, components and merges are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in turn over the documents, each written and read again by the next."""
    docs, older = documents(spark, sf_dir), []
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
        discard(*older)
        older = [docs]
    return STAGES[-1][1](spark, docs, sf_dir)
