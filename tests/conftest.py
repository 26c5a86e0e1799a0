import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    builder = (
        SparkSession.builder.master("local[8]")
        .appName("anchorctx-tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
    )
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    if not session.conf.get("spark.checkpoint.dir", None):
        session.conf.set("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
    return session


@pytest.fixture
def clock(spark):
    """Change the session time zone for one test."""
    before = spark.conf.get("spark.sql.session.timeZone")
    yield lambda zone: spark.conf.set("spark.sql.session.timeZone", zone)
    spark.conf.set("spark.sql.session.timeZone", before)
