"""Nearest events on either side of a moment, without a group per key.

A window over a key's whole history would put a busy key in one task. Here
each history is cut into chunks of time, a window runs inside each
(key, chunk), and one summary row per (key, chunk) tells what the earlier and
later chunks hold.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from anchorctx.functions.clock import check_same_clock, chunk_of
from anchorctx.functions.columns import all_known, listed, names, quoted

DEFAULT_CHUNK_SECONDS = 3600


@dataclass(frozen=True)
class Anchors:
    """Anchor rows with the names of their columns and the length of the time chunks."""

    rows: DataFrame
    key: list[str]
    id: str
    time: str
    ntz: bool
    chunk_seconds: int

    @classmethod
    def against(
        cls,
        other: DataFrame,
        other_time: str,
        rows: DataFrame,
        key: str | Sequence[str],
        id: str,
        time: str,
        chunk_seconds: int = DEFAULT_CHUNK_SECONDS,
    ) -> Anchors:
        """Anchors whose time can be compared with the time of another table."""
        ntz = check_same_clock(rows, time, other, other_time)
        return cls(rows, names(key), id, time, ntz, chunk_seconds)

    def dated(self, events: DataFrame, time: str, *columns) -> DataFrame:
        """(key, ``_chunk``, ``_at``, columns) of the rows that have a key and a time."""
        return events.where(all_known([*self.key, time])).select(
            *self.key,
            chunk_of(time, self.ntz, self.chunk_seconds).alias("_chunk"),
            F.col(time).alias("_at"),
            *columns,
        )

    @cached_property
    def moments(self) -> DataFrame:
        """Distinct (key, ``_chunk``, ``_at``): copies of an anchor are worked on once."""
        return self.dated(self.rows, self.time).distinct()

    def with_results(self, per_moment: DataFrame) -> DataFrame:
        """(key, id, results): each anchor row with the result rows of its moment."""
        return (
            self.rows.where(all_known([*self.key, self.time]))
            .select(*self.key, F.col(self.time).alias("_at"), self.id)
            .join(per_moment, [*self.key, "_at"])
        )


def surroundings(
    anchors: Anchors, times: DataFrame | None = None, reports: DataFrame | None = None
) -> DataFrame:
    """(key, ``_at``, ``_previous``, ``_next``, ``_state``) for every moment of the anchors.

    ``times`` has the key, ``_chunk`` and ``_at`` of events; ``_previous`` and ``_next`` are
    the nearest of them on either side, a moment's own time being on both. ``reports``
    also has ``_seq`` and ``_status``; ``_state`` is the latest report up to the moment whose
    status differs from the key's report before (a NULL on either side differs), as a
    struct of ``since``, ``seq`` and ``status``. Columns of a missing input are left out.

    All rows of a (key, ``_chunk``) meet once, in one exchange. A summary of each such group is
    read from the same exchange, and what earlier and later chunks hold comes back
    to the group by a join, so the rows themselves are not shuffled again.
    """
    key, keys = anchors.key, listed(anchors.key)
    points = anchors.moments.withColumn("_asked", F.lit(True))
    if times is not None:
        points = points.unionByName(
            times.select(
                *key, "_chunk", "_at", F.lit(False).alias("_asked"), F.col("_at").alias("_event")
            ),
            allowMissingColumns=True,
        )
    if reports is not None:
        report = F.expr("struct(_at as since, _seq as seq, _status as status)")
        points = points.unionByName(
            reports.select(
                *key, "_chunk", "_at", F.lit(False).alias("_asked"), report.alias("_report")
            ),
            allowMissingColumns=True,
        )
    points = points.repartition(*key, "_chunk")

    # All frames start at the edge of the partition, so Spark keeps a running
    # value; a frame that ends at the far edge would be recomputed for each row.
    # A moment sorts behind the events and reports of its own time, in both directions.
    so_far = "rows between unbounded preceding and current row"
    until = "rows between unbounded preceding and 1 preceding"
    within = f"partition by {keys}, _chunk"
    order = "order by _at, _asked" + (", _report" if reports is not None else "")
    of_key = f"partition by {keys} order by _chunk"

    found, totals, carried, results = [], [], [], []
    if times is not None:
        totals += ["max(_event) as _late", "min(_event) as _early"]
        carried += [
            f"max(_late) over ({of_key} {until}) as _previous_chunks",
            f"min(_early) over ({of_key} desc {until}) as _next_chunks",
        ]
        results += [
            f"coalesce(max(_event) over ({within} {order} {so_far}), _previous_chunks) as _previous",
            f"coalesce(min(_event) over ({within} order by _at desc, _asked {so_far}),"
            " _next_chunks) as _next",
        ]
    if reports is not None:
        points = points.selectExpr(
            "*", f"last_value(_report) ignore nulls over ({within} {order} {until}) as _before"
        )
        found = ["not coalesce(_before.status = _report.status, false) as _differs"]
        totals += [
            "min(_report) as _first",
            "max(_report) as _last",
            "max(if(_before is not null and _differs, _report, null)) as _change",
        ]
        results += [
            "coalesce(max(if(_differs and (_before is not null or _first_differs), _report, null))"
            f" over ({within} {order} {so_far}), _state_chunks) as _state"
        ]
    points = points.selectExpr("*", *found)
    summary = points.groupBy(*key, "_chunk").agg(
        F.max("_asked").alias("_has_moment"), *map(F.expr, totals)
    )
    if reports is not None:
        summary = summary.selectExpr(
            "*", f"last_value(_last) ignore nulls over ({of_key} {until}) as _last_before"
        ).selectExpr(
            "*", "not coalesce(_last_before.status = _first.status, false) as _first_differs"
        )
        carried += [
            "_first_differs",
            "max(coalesce(_change, if(_first_differs, _first, null)))"
            f" over ({of_key} {until}) as _state_chunks",
        ]
    summary = (
        summary.selectExpr(*map(quoted, key), "_chunk", "_has_moment", *carried)
        .where("_has_moment")
        .drop("_has_moment")
    )
    return (
        points.join(summary, [*key, "_chunk"])
        .selectExpr(*map(quoted, key), "_at", "_asked", *results)
        .where("_asked")
        .drop("_asked")
    )
