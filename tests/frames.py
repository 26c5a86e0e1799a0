"""Small tables as DataFrames with the standard column names."""

from collections import Counter
from datetime import datetime

from pyspark.sql import functions as F

ANCHORS = "order_id int, device_id string, order_creation_time timestamp_ntz"
ACTIVITY = (
    "device_id string, polling_creation_time timestamp_ntz, status_code int, error_code string"
)
LOG = "device_id string, row_num int, cs_creation_time timestamp_ntz, status string"


def at(clock):
    """``HH:MM:SS[.fff]`` on the day of the fixtures."""
    return datetime.fromisoformat(f"2020-01-01 {clock}")


def frame(spark, rows, schema, zoned=False):
    df = spark.createDataFrame(rows, schema)
    if zoned:
        times = [f.name for f in df.schema if f.dataType.typeName() == "timestamp_ntz"]
        df = df.withColumns({c: F.col(c).cast("timestamp") for c in times})
    return df


def bag(df, *columns):
    """Rows as a multiset, zoned times as wall-clock times of the session."""
    zoned = [f.name for f in df.schema if f.dataType.typeName() == "timestamp"]
    df = df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in zoned})
    return Counter(tuple(row) for row in df.select(*(columns or df.columns)).collect())
