"""Time periods around an anchor."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from typing import Literal


@dataclass(frozen=True)
class Period:
    """``seconds`` whole seconds ``before`` or ``after`` an anchor, both ends included."""

    name: str
    direction: Literal["before", "after"]
    seconds: int

    def __post_init__(self):
        if self.direction not in ("before", "after"):
            raise ValueError(f"direction is 'before' or 'after', not {self.direction!r}")
        if self.seconds < 0:
            raise ValueError("a period cannot be shorter than 0 seconds")


# Names and lengths of the standard report's periods.
THREE_MINUTES_BEFORE = Period("THREE_MINUTES_BEFORE", "before", 180)
THREE_MINUTES_AFTER = Period("THREE_MINUTES_AFTER", "after", 180)
ONE_HOUR_BEFORE = Period("ONE_HOUR_BEFORE", "before", 3600)
STANDARD_PERIODS = (THREE_MINUTES_BEFORE, THREE_MINUTES_AFTER, ONE_HOUR_BEFORE)


def check_periods(periods: Iterable[Period]) -> tuple[Period, ...]:
    periods = tuple(periods)
    if not periods or len({period.name for period in periods}) != len(periods):
        raise ValueError("give at least one period, each with its own name")
    return periods
