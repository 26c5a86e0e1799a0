"""The batch job: three CSV inputs to one CSV report."""

from __future__ import annotations

import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from anchorctx.plans.report import context_report
from anchorctx.sources import schemas
from anchorctx.sources.csv_export import export_csv
from anchorctx.sources.csv_source import read_events_csv
from anchorctx.sources.paths import remove, scratch_folder

# Default folders.
INPUT_FOLDER = "data/"
OUTPUT_FOLDER = "analysis_results/"
SCHEMAS = ("orders", "polling", "connectivity_status")


def in_folder(folder: str, name: str) -> str:
    return f"{folder.rstrip('/')}/{name}"


def inputs_from_csv(
    spark: SparkSession,
    input_path: str = INPUT_FOLDER,
    orders: StructType | str = schemas.ORDERS,
    polling: StructType | str = schemas.POLLING,
    connectivity_status: StructType | str = schemas.CONNECTIVITY_STATUS,
) -> list[DataFrame]:
    """The three files of a folder: anchors, activity and state log."""
    files = {
        schemas.ORDERS_FILE: orders,
        schemas.POLLING_FILE: polling,
        schemas.CONNECTIVITY_STATUS_FILE: connectivity_status,
    }
    return [
        read_events_csv(spark, in_folder(input_path, name), schema) for name, schema in files.items()
    ]


def _split(options: dict) -> tuple[dict, dict]:
    """Schemas, and what is for ``context_report``."""
    given = {name: options[name] for name in SCHEMAS if name in options}
    return given, {name: value for name, value in options.items() if name not in SCHEMAS}


def report_from_csv(spark: SparkSession, input_path: str = INPUT_FOLDER, **options) -> DataFrame:
    """The context report of the three files in a folder, which are parsed whenever they are read.

    The schemas ``orders``, ``polling`` and ``connectivity_status`` go to ``inputs_from_csv``, other options to
    ``context_report``. Schemas with other names than the standard ones need these names among the options.
    """
    given, options = _split(options)
    return context_report(*inputs_from_csv(spark, input_path, **given), **options)


def run(
    spark: SparkSession,
    input_path: str = INPUT_FOLDER,
    output_path: str = OUTPUT_FOLDER,
    **options,
) -> str:
    """Read, report and export; returns the path of the report, a folder of part files.

    Each file is parsed once, to a Parquet table in the scratch folder that all passes of the report
    read, with pruned columns and pushed filters; the tables are removed at the end.
    """
    path = in_folder(output_path, schemas.REPORT_FILE)
    given, options = _split(options)
    parsed = inputs_from_csv(spark, input_path, **given)
    folder = scratch_folder(spark, "job")
    try:
        tables = []
        for number, table in enumerate(parsed):
            table.write.parquet(f"{folder}/{number}")
            tables.append(spark.read.schema(table.schema).parquet(f"{folder}/{number}"))
        export_csv(context_report(*tables, **options), path)
    finally:
        remove(spark, folder)
    return path


def main(arguments: list[str]) -> None:
    """``spark-submit anchorctx/plans/job.py [input folder] [output folder]``."""
    print(run(SparkSession.builder.appName("context_report").getOrCreate(), *arguments[:2]))


if __name__ == "__main__":
    main(sys.argv[1:])
