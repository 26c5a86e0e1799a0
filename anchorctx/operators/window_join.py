"""Join each anchor with the events of one period around it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from anchorctx.functions.clock import check_same_clock, chunk_of, whole_seconds
from anchorctx.functions.columns import all_known, names
from anchorctx.functions.periods import Period


def window_join(
    anchors: DataFrame,
    activity: DataFrame,
    period: Period,
    *,
    key: str | Sequence[str] = "device_id",
    anchor_time: str = "order_creation_time",
    event_time: str = "polling_creation_time",
    bucket_seconds: int | None = None,
) -> DataFrame:
    """One row per (anchor, event of the same key in the period): all columns of both.

    An event and its anchor meet in the time bucket of the event. Buckets as
    long as the period mean that an anchor visits two of them, and that a busy
    key is spread over as many groups as its history has buckets.

    The result is the matching pairs themselves. To only count them, use
    ``multi_period_profile``, which never forms them.
    """
    key = names(key)
    ntz = check_same_clock(anchors, anchor_time, activity, event_time)
    bucket_seconds = bucket_seconds or max(period.seconds, 1)
    looks_back = period.direction == "before"

    at = whole_seconds(anchor_time, ntz)
    far_bucket = F.floor(
        (at - period.seconds if looks_back else at + period.seconds) / F.lit(bucket_seconds)
    )
    visits = anchors.where(all_known([*key, anchor_time])).withColumn(
        "_bucket", F.explode(F.sequence(chunk_of(anchor_time, ntz, bucket_seconds), far_bucket))
    )
    events = activity.where(all_known([*key, event_time])).withColumn(
        "_bucket", chunk_of(event_time, ntz, bucket_seconds)
    )

    earlier, later = (event_time, anchor_time) if looks_back else (anchor_time, event_time)
    distance = whole_seconds(later, ntz) - whole_seconds(earlier, ntz)
    return (
        visits.join(events, [*key, "_bucket"])
        .where((F.col(earlier) <= F.col(later)) & (distance <= period.seconds))
        .drop("_bucket")
    )
