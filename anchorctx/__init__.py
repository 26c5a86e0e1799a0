"""What was going on around a moment: event profiles, neighbours and states, on Spark."""

from anchorctx.functions.periods import (
    ONE_HOUR_BEFORE,
    STANDARD_PERIODS,
    THREE_MINUTES_AFTER,
    THREE_MINUTES_BEFORE,
    Period,
)
from anchorctx.operators.neighbours import neighbours, next_event, previous_event
from anchorctx.operators.profile import (
    keep_all_anchors,
    multi_period_profile,
    period_counts,
    window_profile,
)
from anchorctx.operators.state import latest_change, state_as_of, state_changes
from anchorctx.operators.window_join import window_join
from anchorctx.plans.job import report_from_csv, run
from anchorctx.plans.report import context_report, unbounded_context
from anchorctx.sources.csv_export import export_csv
from anchorctx.sources.csv_source import read_events_csv

__all__ = [
    "ONE_HOUR_BEFORE",
    "STANDARD_PERIODS",
    "THREE_MINUTES_AFTER",
    "THREE_MINUTES_BEFORE",
    "Period",
    "context_report",
    "export_csv",
    "keep_all_anchors",
    "latest_change",
    "multi_period_profile",
    "neighbours",
    "next_event",
    "period_counts",
    "previous_event",
    "read_events_csv",
    "report_from_csv",
    "run",
    "state_as_of",
    "state_changes",
    "unbounded_context",
    "window_join",
    "window_profile",
]
