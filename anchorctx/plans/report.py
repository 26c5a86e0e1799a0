"""The context report: what was going on around each anchor."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from anchorctx.functions.clock import check_same_clock, chunk_of
from anchorctx.functions.columns import all_known, any_known, names, quoted
from anchorctx.functions.periods import STANDARD_PERIODS, Period, check_periods
from anchorctx.operators.asof import DEFAULT_CHUNK_SECONDS, Anchors, surroundings
from anchorctx.operators.neighbours import FOUND, NEXT, POOLED, PREVIOUS
from anchorctx.operators.profile import (
    DIMS,
    PERIOD,
    TOTAL,
    each_period,
    event_blocks,
    profile_of,
)
from anchorctx.operators.state import SINCE, STATUS, reports_of


SIDES = [PREVIOUS, NEXT]


def _per_key(
    anchors: Anchors, times: DataFrame, reports: DataFrame, unplaced: DataFrame | None = None
) -> DataFrame:
    """State and neighbours per anchor id and key, both found in one pass over both histories.

    ``unplaced`` holds the id and key of anchors that cannot meet any event; they are among the rows.
    """
    per_moment = surroundings(anchors, times, reports).withColumnsRenamed(FOUND)
    per_anchor = anchors.with_results(per_moment).drop("_at")
    if unplaced is not None:
        per_anchor = per_anchor.unionByName(unplaced, allowMissingColumns=True)
    return per_anchor.groupBy(anchors.id, *anchors.key).agg(
        *[POOLED[side](side).alias(side) for side in SIDES], F.max("_state").alias("_state")
    )


def _context(anchors: Anchors, per_key: DataFrame) -> DataFrame:
    """State and neighbours per anchor id: a row per key with a state, with the neighbours of all keys."""
    # States and neighbours below both read all columns of `per_key`, so that
    # Spark sees the same input twice and runs it once. The neighbours of an id
    # on one key are never nearer than those over all its keys, which come first.
    around = per_key.groupBy(anchors.id).agg(
        *[POOLED[side](side).alias(side) for side in SIDES], F.count("_state").alias("_states")
    )
    id_ = quoted(anchors.id)
    # A missing id matches nothing: its states are without neighbours.
    with_state = (
        per_key.where("_state is not null")
        .selectExpr(id_, "_state", f"{PREVIOUS} as _previous", f"{NEXT} as _next")
        .join(around, anchors.id, "left")
        .selectExpr(
            id_,
            f"_state.status as {STATUS}",
            f"_state.since as {SINCE}",
            f"if(_states is null, null, coalesce({PREVIOUS}, _previous)) as {PREVIOUS}",
            f"if(_states is null, null, coalesce({NEXT}, _next)) as {NEXT}",
        )
    )
    without_state = around.where(f"_states = 0 or {id_} is null").select(anchors.id, *SIDES)
    return with_state.unionByName(without_state, allowMissingColumns=True)


def _context_of_ids(anchors: Anchors, per_key: DataFrame) -> DataFrame:
    """The same, where rows without an id have no state and come as one: a window over the keys of an id."""
    of_id = f"over (partition by {quoted(anchors.id)})"
    first = f"row_number() over (partition by {quoted(anchors.id)} order by _state is null)"
    return (
        per_key.selectExpr(
            quoted(anchors.id), "_state", f"max({PREVIOUS}) {of_id} as {PREVIOUS}",
            f"min({NEXT}) {of_id} as {NEXT}", f"{first} as _place",
        )
        .where("_state is not null or _place = 1")
        .selectExpr(
            quoted(anchors.id), f"_state.status as {STATUS}", f"_state.since as {SINCE}", *SIDES
        )
    )


def unbounded_context(
    anchors: DataFrame,
    activity: DataFrame,
    states: DataFrame,
    *,
    key: str | Sequence[str] = "device_id",
    anchor_id: str = "order_id",
    anchor_time: str = "order_creation_time",
    event_time: str = "polling_creation_time",
    state_time: str = "cs_creation_time",
    status: str = "status",
    seq: str = "row_num",
    chunk_seconds: int = DEFAULT_CHUNK_SECONDS,
) -> DataFrame:
    """State and neighbours of each anchor id that has any, however far away.

    An id used on several keys has one row per key with a state.
    """
    check_same_clock(anchors, anchor_time, states, state_time)
    asked = Anchors.against(
        activity, event_time, anchors, key, anchor_id, anchor_time, chunk_seconds
    )
    per_key = _per_key(
        asked,
        asked.dated(activity, event_time).distinct(),
        reports_of(asked, states, state_time, status, seq),
    )
    return _context(asked, per_key).where(any_known([SINCE, PREVIOUS, NEXT]))


def context_report(
    anchors: DataFrame,
    activity: DataFrame,
    states: DataFrame,
    periods: Iterable[Period] = STANDARD_PERIODS,
    *,
    key: str | Sequence[str] = "device_id",
    anchor_id: str = "order_id",
    anchor_time: str = "order_creation_time",
    event_time: str = "polling_creation_time",
    dims: Sequence[str] = DIMS,
    state_time: str = "cs_creation_time",
    status: str = "status",
    seq: str = "row_num",
    chunk_seconds: int = DEFAULT_CHUNK_SECONDS,
) -> DataFrame:
    """Profile of every anchor id and period, with the id's state and neighbours."""
    dims, periods = names(dims), check_periods(periods)
    check_same_clock(anchors, anchor_time, states, state_time)
    key = names(key)
    named, placed = all_known([anchor_id]), all_known([anchor_id, *key, anchor_time])
    asked = Anchors.against(
        activity,
        event_time,
        anchors.where(placed),
        key,
        anchor_id,
        anchor_time,
        chunk_seconds,
    )

    blocks = event_blocks(asked, activity, event_time, dims, periods)
    # Reading `_n` here too makes this the same aggregation of the activity as
    # the profile's, so Spark runs it once and reuses its exchange.
    times = (
        blocks.withColumn("_at", F.expr("if(_n > 0, _exact, null)"))
        .where("_at is not null")
        .withColumn("_chunk", chunk_of("_at", asked.ntz, chunk_seconds))
    )
    reports = reports_of(asked, states, state_time, status, seq)
    # Anchors without an id are one id on no key, however many lack one: no counts, no context.
    unplaced = anchors.where(~placed).select(
        anchor_id, *[F.when(named, F.col(column)).alias(column) for column in key]
    )
    context = _context_of_ids(asked, _per_key(asked, times, reports, unplaced))
    report = each_period(context, periods).join(
        profile_of(asked, blocks, periods, dims), [anchor_id, PERIOD], "left"
    )
    by_dim = [column for dim in dims for column in (dim, f"count_{dim}")]
    return report.select(
        anchor_id, STATUS, SINCE, PREVIOUS, NEXT, PERIOD, TOTAL, *by_dim
    )
