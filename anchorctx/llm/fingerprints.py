"""Document fingerprints: threshold-scaled sketches of word shingles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from anchorctx.llm.common import documents, row_key, saved, text_or_empty

WORD = r"[^\x20\x09-\x0D]+"
SHINGLE_WORDS = 5
SCALE = 8


def with_sketch(
    df: DataFrame, text: str, sketch: str, scale: int = SCALE, shingle_words: int = SHINGLE_WORDS
) -> DataFrame:
    """``df`` with the sketch of ``text`` as a sorted array of hashes.

    A shingle is ``shingle_words`` words between white space, or all words of a shorter text.
    Of the distinct shingle hashes those in the lowest 1/``scale`` of their range are
    kept, however many; where there is none, the least. So the sketch of a union is the union
    of sketches, less what lies beyond the threshold if anything lies below it.
    Texts without words have an empty sketch, null texts a null one.
    """
    words, hashes = f"_words_{sketch}", f"_hashes_{sketch}"
    positions = F.slice(words, 1, F.greatest(F.lit(1), F.size(words) - (shingle_words - 1)))
    all_hashes = F.transform(
        positions,
        lambda word, i: F.xxhash64(
            word, *[F.get(F.col(words), i + k) for k in range(1, shingle_words)]
        ),
    )
    below = -(1 << 63) + (1 << 64) // scale
    kept = F.filter(hashes, lambda h: h < F.lit(below))
    least = F.array(F.array_min(hashes))
    return (
        df.withColumn(words, F.regexp_extract_all(F.col(text), F.lit(WORD), F.lit(0)))
        .withColumn(hashes, all_hashes)
        .withColumn(sketch, kept)
        .withColumn(
            sketch,
            F.when((F.size(sketch) == 0) & (F.size(hashes) > 0), least)
            .otherwise(F.array_sort(F.array_distinct(sketch))),
        )
        .drop(words, hashes)
    )


def containment(sketch: str, other: str) -> Column:
    """The estimated share of a text's shingles that another text has; of none, whether both have none."""
    shared = F.size(F.array_intersect(sketch, other))
    return (
        F.when(F.size(sketch) > 0, shared / F.size(sketch))
        .otherwise(F.when(F.size(other) > 0, 0.0).otherwise(1.0))
    )


def as_text(sketch: str) -> Column:
    return F.array_join(
        F.transform(sketch, lambda h: F.lower(F.lpad(F.hex(h), 16, "0"))), ""
    )


def _next_documents(docs: DataFrame) -> DataFrame:
    """(key, next_key, need) in descending doc_id, the last followed by the first.

    Sorted by range; a row's number is its place in its partition after the rows of the
    partitions before, so no task sees more than its range and the partitions' sizes.
    """
    keys = docs.select("doc_id", "key", "n_chars").distinct()
    ordered = keys.orderBy(F.desc_nulls_last("doc_id"), "key")
    placed = saved(ordered.withColumn("_at", F.monotonically_increasing_id()), "next-placed")
    placed = placed.withColumn("_part", F.shiftright("_at", 33))
    parts = placed.groupBy("_part").agg(F.count("*").alias("_rows"))
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select(
        "_part", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_before")
    )
    total = placed.count()
    numbered = saved(
        # As many rows as the sort has partitions.
        placed.join(F.broadcast(parts), "_part").select(
            "key",
            F.floor(F.col("n_chars") / 3).cast("int").alias("need"),
            (F.col("_before") + F.col("_at") - F.shiftleft("_part", 33)).alias("number"),
        ),
        "next-numbered",
    )
    following = numbered.select(F.col("key").alias("next_key"), "number")
    here = numbered.withColumn("number", (F.col("number") + 1) % F.lit(max(total, 1)))
    return saved(here.join(following, "number").select("key", "next_key", "need"), "next-keys")


def fingerprint_documents(
    docs: DataFrame,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    scale: int = SCALE,
    shingle_words: int = SHINGLE_WORDS,
) -> DataFrame:
    """Every row with its sketch, that of its edited text, and estimates of containment.

    The edited text ends in the first third of the next document, in descending doc_id, in place
    of its own last third (floor(n / 3) code points). ``near_edited`` and ``near_next`` are the
    estimated shares of the text's shingles that the edited text and the next document have.

    Rows equal in id and text are one document, and come out alike, as often as they came in;
    documents of one id follow each other in the order of a hash. Null ids come last. A null
    text counts as empty. The only document is its own next one. An empty table gives an
    empty result. Other columns are not read.
    """
    rows = docs.select(
        F.col(doc_id).cast("bigint").alias("doc_id"),
        text_or_empty(text).alias("body"),
    )
    rows = rows.withColumn("key", row_key("doc_id", "body"))
    following = _next_documents(rows.withColumn("n_chars", F.char_length("body")))
    rows = with_sketch(rows, "body", "sketch", scale, shingle_words)
    # Both joins read one exchange of the texts, as neither side has names of its own in it.
    heads = (
        following.alias("pair")
        .join(rows.alias("other"), F.col("pair.next_key") == F.col("other.key"))
        .select(
            F.col("pair.key"),
            F.col("other.doc_id").alias("next_doc_id"),
            F.expr("substring(other.body, 1, pair.need)").alias("head"),
            F.col("other.sketch").alias("next_sketch"),
        )
        # The next document may be in the table more than once.
        .groupBy("key").agg(
            F.first("next_doc_id").alias("next_doc_id"),
            F.first("head").alias("head"),
            F.first("next_sketch").alias("next_sketch"),
        )
    )
    joined = (
        rows.join(heads, "key")
        .withColumn("n_chars", F.char_length("body").cast("bigint"))
        .withColumn(
            "edited",
            F.concat(F.expr("substring(body, 1, cast(n_chars - n_chars div 3 as int))"), "head"),
        )
    )
    return with_sketch(joined, "edited", "edited_sketch", scale, shingle_words)


def op2_fingerprints(spark, sf_dir):
    found = fingerprint_documents(documents(spark, sf_dir))
    return found.select(
        "doc_id",
        "n_chars",
        F.sha2("edited", 256).alias("edited_sha256"),
        as_text("sketch").alias("fingerprint"),
        as_text("edited_sketch").alias("edited_fingerprint"),
        containment("sketch", "edited_sketch").alias("near_edited"),
        containment("sketch", "next_sketch").alias("near_next"),
        "next_doc_id",
    )
