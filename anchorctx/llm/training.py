"""What the two classifiers share: labelled rows to learn from, and statistics of texts."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from anchorctx.llm.common import held_out, row_key, saved


def labelled_sample(
    labels: DataFrame, label: str, mod: int, remainder: int, most: int, doc_id: str = "doc_id"
) -> DataFrame:
    """At most ``most`` labelled ids that are not held out, by the order of a hash: (doc_id, label).

    An id labelled more than once has its highest label; rows without id or label are left out.
    """
    rows = (
        labels.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(label).cast("double").alias("label"))
        .where("doc_id is not null and label is not null")
        .where(~held_out("doc_id", mod, remainder))
        .groupBy("doc_id").agg(F.max("label").alias("label"))
    )
    return saved(rows.orderBy(F.xxhash64("doc_id", F.lit("sample")), "doc_id").limit(most), "labelled")


def with_statistics(
    docs: DataFrame,
    names: list[str],
    of: Callable[[bytes], list[float]],
    *,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """(doc_id, row_key, one double per name) of every row; a null text counts as empty."""
    schema = StructType([StructField(name, DoubleType()) for name in names])

    @F.pandas_udf(schema)
    def statistics(texts: pd.Series) -> pd.DataFrame:
        rows = np.array([of(bytes(t)) for t in texts], dtype=float).reshape(-1, len(names))
        return pd.DataFrame(rows, columns=names)

    body = F.coalesce(F.col(text), F.lit("")).cast("binary")
    return docs.select(
        F.col(doc_id).cast("bigint").alias("doc_id"),
        row_key(doc_id, text).alias("row_key"),
        statistics(body).alias("_s"),
    ).select("doc_id", "row_key", "_s.*")


def byte_shares(body: bytes) -> dict[str, float]:
    """Shares of kinds of bytes; bytes beyond ASCII count as letters."""
    counts = np.bincount(np.frombuffer(body, dtype=np.uint8), minlength=256)
    n = max(1, len(body))
    lower, upper = counts[97:123].sum(), counts[65:91].sum()
    letters = lower + upper + counts[128:].sum()
    space = counts[[9, 10, 11, 12, 13, 32]].sum()
    digits = counts[48:58].sum()
    stops = counts[[33, 44, 46, 58, 59, 63]].sum()
    return {
        "letters": letters / n,
        "upper": upper / max(1, letters),
        "digits": digits / n,
        "space": space / n,
        "stops": stops / n,
        "shouts": (counts[33] + counts[63]) / n,
        "symbols": (len(body) - letters - space - digits - stops) / n,
    }
