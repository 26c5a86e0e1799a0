"""CSV input whose columns are declared, not guessed."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def read_events_csv(
    spark: SparkSession,
    path: str | list[str],
    schema: StructType | str,
    header: bool = True,
) -> DataFrame:
    """Columns of the files under the names and types of ``schema``, by position.

    Names in the files' header lines are skipped, whatever they are. A field that
    does not parse is NULL and leaves the others of its row alone; missing
    fields at the end of a row are NULL, and so are empty ones.
    """
    return spark.read.csv(
        path, schema=schema, header=header, enforceSchema=True, mode="PERMISSIVE"
    )
