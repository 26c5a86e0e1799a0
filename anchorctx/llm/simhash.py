"""SimHash near-duplicates by covering locality-sensitive hashing."""

from __future__ import annotations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from anchorctx.llm.common import connected_components, discard, documents, row_key, saved, unused

BITS = 64
SEED = 42
# Shingles whose bits are counted at a time, so that a long text needs little memory.
SHINGLES_AT_ONCE = 1 << 16


def fingerprint(text: bytes | None, shingle_words: int) -> int:
    """The SimHash of one text; zero without words."""
    words = (text or b"").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = ends - lengths
    if len(words) > shingle_words:
        starts, ends = starts[: 1 - shingle_words or None], ends[shingle_words - 1 :]
    else:
        starts, ends = starts[:1], ends[-1:]
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter(
        (digest(joined[s:e], SEED) for s, e in zip(starts.tolist(), ends.tolist(), strict=True)),
        dtype=np.uint64,
        count=len(starts),
    )
    counts = np.zeros(BITS, dtype=np.int64)
    for at in range(0, len(hashes), SHINGLES_AT_ONCE):
        part = hashes[at : at + SHINGLES_AT_ONCE].astype("<u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(counts * 2 > len(hashes), bitorder="little")
    return int(bits.view("<u8")[0])


def fingerprints(
    docs: DataFrame, shingle_words: int, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """(doc_id, fp, row_key) of every row; ``fp`` is the unsigned fingerprint as a signed long."""

    @F.pandas_udf("bigint")
    def simhash(texts: pd.Series) -> pd.Series:
        found = np.array([fingerprint(t, shingle_words) for t in texts], dtype=np.uint64)
        return pd.Series(found.view(np.int64))

    return docs.select(
        F.col(doc_id).cast("bigint").alias("doc_id"),
        simhash(F.col(text).cast("binary")).alias("fp"),
        row_key(doc_id, text).alias("row_key"),
    )


def covering_masks(radius: int) -> list[int]:
    """Masks such that any ``radius`` bits lie outside at least one of them together.

    Bit i carries the nonzero vector (i mod (2^(radius+1) - 1)) + 1 over GF(2); the mask of a
    nonzero vector v keeps the bits whose vector has product 1 with v. The vectors
    of ``radius`` bits cannot span radius + 1 dimensions, so some v is at right angles to
    all of them, and its mask leaves those bits out: two fingerprints that differ in
    them alone agree under it.
    """
    vectors = (1 << (radius + 1)) - 1
    return [
        sum(1 << i for i in range(BITS) if ((i % vectors + 1) & v).bit_count() % 2)
        for v in range(1, vectors + 1)
    ]


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def _bits_apart(a: str, b: str):
    return F.bit_count(F.col(a).bitwiseXOR(F.col(b)))


def _links_across(max_bits: int):
    """For one block pair of a bucket: links that join its components, each once."""

    def links(rows: pd.DataFrame) -> pd.DataFrame:
        fps = rows["fp"].to_numpy().view(np.uint64)
        parts = rows["component"].to_numpy()
        root: dict[int, int] = {}

        def find(x: int) -> int:
            while (up := root.get(x, x)) != x:
                x = up
            return x

        found = []
        for i in range(1, len(fps)):
            near = np.flatnonzero(np.bitwise_count(fps[:i] ^ fps[i]) <= max_bits)
            for j in near[parts[near] != parts[i]]:
                x, y = find(int(parts[i])), find(int(parts[j]))
                if x != y:
                    root[max(x, y)] = min(x, y)
                    found.append((int(fps[i].view(np.int64)), int(fps[j].view(np.int64))))
        return pd.DataFrame(found, columns=["a", "b"], dtype=np.int64)

    return links


def linked_fingerprints(distinct: DataFrame, max_bits: int, block: int = 4096) -> DataFrame:
    """(node, component) of the fingerprints with a neighbour within ``max_bits`` bits.

    ``distinct`` has each fingerprint once as ``fp``. Every pair within the radius
    meets in a bucket of some mask. First each bucket's fingerprints are held against its
    least one, a linear number of pairs. Where a bucket of three or more is not yet
    one component, its members of different components are compared, in blocks of at most
    ``block`` fingerprints, whose tasks pass on no more links than they join components. So no
    link that matters is missed, and no group's pairs are written out.
    """
    masks = F.array(*[F.lit(_signed(m)) for m in covering_masks(max_bits)])
    bucketed = distinct.select("fp", F.posexplode(masks).alias("table", "_mask")).select(
        "fp", "table", F.col("fp").bitwiseAND(F.col("_mask")).alias("bucket")
    )
    shared = (
        bucketed.groupBy("table", "bucket")
        .agg(F.count("*").alias("members"), F.min("fp").alias("least"))
        .where("members > 1")
    )
    # A table of its own, so that Spark may split the join at a large bucket.
    shared = saved(shared, "simhash-shared")
    met = saved(bucketed.join(shared, ["table", "bucket"]), "simhash-met")
    discard(shared)
    stars = (
        met.where(F.col("fp") != F.col("least"))
        .where(_bits_apart("fp", "least") <= max_bits)
        .select(F.col("fp").alias("a"), F.col("least").alias("b"))
    )
    first = saved(connected_components(stars, "simhash"), "simhash-first")

    labelled = (
        met.where("members > 2")
        .join(first.withColumnRenamed("node", "fp"), "fp", "left")
        .withColumn("component", F.coalesce("component", "fp"))
    )
    labelled = saved(labelled, "simhash-labelled")
    mixed = saved(
        labelled.groupBy("table", "bucket")
        .agg(F.min("component").alias("_low"), F.max("component").alias("_high"))
        .where("_low <> _high")
        .select("table", "bucket"),
        "simhash-mixed",
    )
    blocks = F.ceil(F.col("members") / block)
    own = F.pmod(F.xxhash64("fp", F.lit("block")), blocks)
    more = (
        labelled.join(mixed, ["table", "bucket"])
        .withColumn("_own", own)
        .withColumn("_other", F.explode(F.sequence(F.lit(0).cast("bigint"), blocks - 1)))
        .select(
            "table", "bucket", "fp", "component",
            F.least("_own", "_other").alias("_one"), F.greatest("_own", "_other").alias("_two"),
        )
        .groupBy("table", "bucket", "_one", "_two")
        .applyInPandas(_links_across(max_bits), "a bigint, b bigint")
    )
    more = saved(more, "simhash-more")
    discard(met, labelled, mixed)
    if more.isEmpty():
        return first
    tree = first.select(F.col("node").alias("a"), F.col("component").alias("b"))
    linked = saved(connected_components(tree.unionByName(more), "simhash"), "simhash-all")
    discard(first, more)
    return linked


def simhash_groups(
    docs: DataFrame,
    *,
    shingle_words: int = 4,
    max_bits: int = 4,
    doc_id: str = "doc_id",
    text: str = "text",
    block: int = 4096,
) -> DataFrame:
    """(doc_id, fingerprint, component_id, component, row_key) for every row of ``docs``.

    Words are runs of other characters than ASCII white space, A-Z in lower case. A shingle is
    ``shingle_words`` words joined by spaces, or the whole text if it is shorter; repeats count.
    A bit of the fingerprint is set if more than half of the shingles' XXH64
    (seed 42) have it. Fingerprints ``max_bits`` or fewer bits apart are linked;
    ``component_id`` is the least doc_id that links reach. Texts without words, null ones
    included, have fingerprint zero and are linked like any other. Null ids
    are passed over by the least id, which is null if there is no other. Repeated rows come out
    as often as they came in. An empty table gives an empty result. Other columns are not read.
    """
    rows = saved(fingerprints(docs, shingle_words, doc_id, text), "simhash-rows")
    per_fp = saved(rows.groupBy("fp").agg(F.min("doc_id").alias("least_id")), "simhash-distinct")
    linked = linked_fingerprints(per_fp.select("fp"), max_bits, block)
    named = (
        per_fp.join(linked.withColumnRenamed("node", "fp"), "fp", "left")
        .withColumn("component", F.coalesce("component", "fp"))
    )
    named = saved(named, "simhash-named")
    least = saved(
        named.groupBy("component").agg(F.min("least_id").alias("component_id")), "simhash-least"
    )
    component = saved(
        named.join(least, "component").select("fp", "component", "component_id"),
        "simhash-components",
    )
    discard(per_fp, linked, named, least)
    return rows.join(component, "fp").select(
        "doc_id",
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        "component_id",
        "component",
        "row_key",
    )


def one_of_each_group(docs: DataFrame, **options) -> DataFrame:
    """``docs`` with one row of each group of ``simhash_groups``: one of the least id.

    Null ids come last; of rows with that id, the one whose text has the least hash stays, once.
    Columns are kept as they are, whatever their names.
    """
    name, copy = unused("_row_key", docs), unused("_copy", docs)
    key = row_key(options.get("doc_id", "doc_id"), options.get("text", "text"))
    stays = (
        simhash_groups(docs, **options)
        .groupBy("component")
        .agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "row_key")).alias("_first"))
        .select(F.col("_first.row_key").alias(name))
    )
    copies = Window.partitionBy(name).orderBy(name)
    return (
        docs.withColumn(name, key)
        .join(stays, name, "left_semi")
        .withColumn(copy, F.row_number().over(copies))
        .where(F.col(copy) == 1)
        .drop(name, copy)
    )


def op4_simhash(spark, sf_dir):
    return simhash_groups(documents(spark, sf_dir)).drop("component", "row_key")
