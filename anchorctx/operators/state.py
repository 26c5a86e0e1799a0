"""States of a device: changes in the log, and the state at an anchor."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from anchorctx.functions.clock import chunk_of, is_ntz
from anchorctx.functions.columns import all_known, listed, names, quoted
from anchorctx.operators.asof import DEFAULT_CHUNK_SECONDS, Anchors, surroundings

# Names of the result columns.
STATUS = "most_recent_status"
SINCE = "most_recent_status_change_time"


def state_changes(
    log: DataFrame,
    *,
    key: str | Sequence[str] = "device_id",
    state_time: str = "cs_creation_time",
    status: str = "status",
    seq: str = "row_num",
    chunk_seconds: int = DEFAULT_CHUNK_SECONDS,
) -> DataFrame:
    """The log with ``status_change_time``: the report's time if its status differs from
    the key's report before, else NULL.

    Reports at one time are taken in the order of ``seq``. Reports without key
    or time belong to no history and are left out.
    """
    key = names(key)
    keys, one = listed(key), quoted(status)
    # One exchange of the log serves the reports and the last of each chunk.
    reports = (
        log.where(all_known([*key, state_time]))
        .select(
            *key,
            state_time,
            seq,
            status,
            chunk_of(state_time, is_ntz(log, state_time), chunk_seconds).alias("_chunk"),
        )
        .repartition(*key, "_chunk")
    )
    in_order = f"partition by {keys}, _chunk order by {listed([state_time, seq, status])}"
    # The status goes in a struct, so that a NULL status and no report at all stay apart.
    reports = reports.selectExpr(
        "*",
        f"lag(struct({one} as status)) over ({in_order}) as _before",
        f"lead(true) over ({in_order}) as _followed",
    )
    chunks = reports.where("_followed is null").selectExpr(
        *map(quoted, key),
        "_chunk",
        f"lag(struct({one} as status)) over (partition by {keys} order by _chunk) as _chunk_before",
    )
    same = f"coalesce(coalesce(_before, _chunk_before).status = {one}, false)"
    return reports.join(chunks, [*key, "_chunk"]).selectExpr(
        *map(quoted, [*key, state_time, seq, status]),
        f"if({same}, null, {quoted(state_time)}) as status_change_time",
    )


def latest_change(
    changes: DataFrame,
    *,
    key: str | Sequence[str] = "device_id",
    change_time: str = "status_change_time",
    status: str = "status",
    seq: str = "row_num",
) -> DataFrame:
    """Per key: the row with the highest change time; the highest ``seq`` settles ties."""
    key = names(key)
    return (
        changes.where(all_known([change_time]))
        .groupBy(*key)
        .agg(F.max(F.struct(change_time, seq, status)).alias("_last"))
        .select(
            *key,
            F.col("_last")[status].alias(STATUS),
            F.col("_last")[change_time].alias(SINCE),
        )
    )


def reports_of(
    anchors: Anchors, log: DataFrame, state_time: str, status: str, seq: str
) -> DataFrame:
    """(key, ``_chunk``, ``_at``, ``_seq``, ``_status``): the log as ``surroundings`` takes it.

    Reports of a key with one time and status are reduced to the one with the highest ``seq``.
    This keeps the state after that time, and whether it changed then, and removes
    copies before they are shuffled.
    """
    return (
        anchors.dated(log, state_time, F.col(seq).alias("_seq"), F.col(status).alias("_status"))
        .groupBy(*anchors.key, "_chunk", "_at", "_status")
        .agg(F.max("_seq").alias("_seq"))
    )


def state_as_of(
    anchors: DataFrame,
    log: DataFrame,
    *,
    key: str | Sequence[str] = "device_id",
    anchor_id: str = "order_id",
    anchor_time: str = "order_creation_time",
    state_time: str = "cs_creation_time",
    status: str = "status",
    seq: str = "row_num",
    chunk_seconds: int = DEFAULT_CHUNK_SECONDS,
) -> DataFrame:
    """Per (anchor id, key): the state at the anchor and the time the key changed to it.

    Anchors without a report at or before them are left out. Where several
    reports share a time, the highest ``seq`` counts.
    """
    asked = Anchors.against(log, state_time, anchors, key, anchor_id, anchor_time, chunk_seconds)
    reports = reports_of(asked, log, state_time, status, seq)
    per_moment = surroundings(asked, reports=reports).where("_state is not null")
    return (
        asked.with_results(per_moment)
        .groupBy(anchor_id, *asked.key)
        .agg(F.max("_state").alias("_state"))
        .select(
            anchor_id,
            *asked.key,
            F.col("_state.status").alias(STATUS),
            F.col("_state.since").alias(SINCE),
        )
    )
