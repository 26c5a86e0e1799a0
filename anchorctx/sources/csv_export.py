"""CSV output as a folder of part files."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame

from anchorctx.sources.paths import publish, remove

# The layout of times, with all their digits.
TIMESTAMP = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"
TIMESTAMP_NTZ = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


def export_csv(
    df: DataFrame,
    path: str,
    timestamp_format: str = TIMESTAMP,
    timestamp_ntz_format: str = TIMESTAMP_NTZ,
) -> None:
    """Write ``df`` to the folder ``path``, each part file with a header line.

    Empty strings look like NULLs in the files. Times are written in the session's zone to the
    microsecond; ``"yyyy-MM-dd'T'HH:mm:ss.SSSXXX"`` cuts them to milliseconds.

    The folder is written under another name beside ``path`` and renamed when it is whole. What is
    at ``path`` stays until then and is removed last, so a run that fails leaves the old result as
    it is. Where a store has no rename of folders, readers may see neither for a moment.
    """
    spark, target = df.sparkSession, path.rstrip("/")
    parent, _, name = target.rpartition("/")
    staged = f"{parent}{'/' if '/' in target else ''}_{name}-{uuid.uuid4().hex}"
    try:
        (
            df.write.option("timestampFormat", timestamp_format)
            .option("timestampNTZFormat", timestamp_ntz_format)
            .csv(staged, header=True, emptyValue="")
        )
        publish(spark, staged, target)
    finally:
        remove(spark, staged)
