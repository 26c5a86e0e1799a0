"""Previous and next event of an anchor, however far away."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from anchorctx.functions.columns import any_known
from anchorctx.operators.asof import DEFAULT_CHUNK_SECONDS, Anchors, surroundings

# Names of the result columns.
PREVIOUS = "preceding_event_time"
NEXT = "following_event_time"

FOUND = {"_previous": PREVIOUS, "_next": NEXT}
# Of anchor rows that share an id, the nearest event counts.
POOLED = {PREVIOUS: F.max, NEXT: F.min}


def neighbours(
    anchors: DataFrame,
    activity: DataFrame,
    *,
    key: str | Sequence[str] = "device_id",
    anchor_id: str = "order_id",
    anchor_time: str = "order_creation_time",
    event_time: str = "polling_creation_time",
    chunk_seconds: int = DEFAULT_CHUNK_SECONDS,
    sides: Sequence[str] = (PREVIOUS, NEXT),
) -> DataFrame:
    """Per anchor id: time of the last event at or before and the first at or after it.

    Ids without an event on either side are left out. An event at the anchor's
    own time is both. Anchor rows that share an id are pooled.
    """
    asked = Anchors.against(
        activity, event_time, anchors, key, anchor_id, anchor_time, chunk_seconds
    )
    # Copies of an event time are removed before they are shuffled.
    times = asked.dated(activity, event_time).distinct()
    per_moment = surroundings(asked, times=times).withColumnsRenamed(FOUND).where(any_known(sides))
    return (
        asked.with_results(per_moment)
        .groupBy(anchor_id)
        .agg(*[POOLED[side](side).alias(side) for side in sides])
    )


def previous_event(anchors: DataFrame, activity: DataFrame, **columns) -> DataFrame:
    """Per anchor id: time of the last event at or before it, if there is one."""
    return neighbours(anchors, activity, sides=[PREVIOUS], **columns)


def next_event(anchors: DataFrame, activity: DataFrame, **columns) -> DataFrame:
    """Per anchor id: time of the first event at or after it, if there is one."""
    return neighbours(anchors, activity, sides=[NEXT], **columns)
