"""Small helpers for column names given as arguments."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def names(columns: str | Sequence[str]) -> list[str]:
    return [columns] if isinstance(columns, str) else list(columns)


def quoted(name: str) -> str:
    """The name as it has to be written in a SQL expression."""
    return "`" + name.replace("`", "``") + "`"


def all_known(columns: Sequence[str]) -> Column:
    """No NULL in any of the columns, i.e. the row can match in an equality join."""
    return F.expr(" and ".join(f"{quoted(c)} is not null" for c in columns))


def any_known(columns: Sequence[str]) -> Column:
    return F.expr(" or ".join(f"{quoted(c)} is not null" for c in columns))


def listed(columns: Sequence[str]) -> str:
    """The names as a list in a SQL expression."""
    return ", ".join(map(quoted, columns))
