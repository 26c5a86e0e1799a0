"""How many events lie in periods around an anchor, split by their dimensions.

``window_profile`` counts pairs that were already joined. The other functions
count without forming pairs: events are added up in aligned blocks of 1, 8, 64
and more seconds, and a period is put together from the fewest such blocks, so
it meets some blocks per level, however long it is and however many events it holds.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from anchorctx.functions.clock import seconds_sql
from anchorctx.functions.columns import all_known, listed, names, quoted
from anchorctx.functions.periods import STANDARD_PERIODS, Period, check_periods
from anchorctx.operators.asof import Anchors

# Names of the result columns and the standard dimensions.
PERIOD = "period_of_time"
TOTAL = "count_polling_events"
DIMS = ("status_code", "error_code")

# Blocks of a level are this many times as long as those of the level below.
BASE = 8
# Levels that only tell which blocks have events, and that of what needs no second look.
_ANY, _DONE = 100, -2


def _marginals(counts: DataFrame, key: Sequence[str], dims: Sequence[str]) -> DataFrame:
    """Joint counts ``_n`` per key and dims, to the total and one marginal count per dim."""
    columns = [f"sum(_n) over (partition by {listed(key)}) as {TOTAL}"]
    for dim in dims:
        within = f"partition by {listed([*key, dim])}"
        columns += [quoted(dim), f"sum(_n) over ({within}) as {quoted(f'count_{dim}')}"]
    return counts.selectExpr(*map(quoted, key), *columns)


def window_profile(
    joined: DataFrame,
    *,
    anchor_id: str | Sequence[str] = "order_id",
    dims: Sequence[str] = DIMS,
) -> DataFrame:
    """Profile of already joined pairs: one row per seen combination of dims.

    ``count_<dim>`` counts all pairs of the anchor with that value of the dim,
    whatever the other dims are. NULL is a value like any other.
    """
    key, dims = names(anchor_id), names(dims)
    counts = joined.groupBy(*key, *dims).agg(F.count(F.lit(1)).alias("_n"))
    return _marginals(counts, key, dims)


def keep_all_anchors(
    anchors: DataFrame, profile: DataFrame, name: str, *, anchor_id: str = "order_id"
) -> DataFrame:
    """Every anchor row with its profile, or one row of NULLs; ``name`` tags the period."""
    counts = [c for c in profile.columns if c not in (anchor_id, PERIOD)]
    return (
        anchors.select(anchor_id)
        .join(profile.select(anchor_id, *counts), anchor_id, "left")
        .select(anchor_id, F.lit(name).alias(PERIOD), *counts)
    )


def _levels(periods: Sequence[Period]) -> range:
    """Blocks have BASE ** level seconds; none is longer than the longest period."""
    longest = max(period.seconds for period in periods)
    level = 0
    while BASE ** (level + 1) <= longest:
        level += 1
    return range(level + 1)


def event_blocks(
    anchors: Anchors,
    activity: DataFrame,
    event_time: str,
    dims: Sequence[str],
    periods: Sequence[Period],
) -> DataFrame:
    """(key, ``_level``, ``_block``, ``_exact``, dims, ``_n``): events added up in blocks.

    On level -1 a block is a second whose events keep their times, for the anchors in it. On level
    _ANY + n is one row for each block of level n that has events, without dims, if periods are first
    cut by level n. Events are added up before they are shuffled, copies and those of a block alike.
    """
    key, levels = list(map(quoted, anchors.key)), _levels(periods)
    by_dims = [*map(quoted, dims)]
    no_dims = [f"null as {dim}" for dim in by_dims]

    def struct(*fields: str) -> str:
        return f"struct({', '.join(fields)})"

    def block(number: int, level: int, split: list[str]) -> str:
        at = f"coalesce(floor(_second / {BASE**level}), 0)"
        return struct(f"{number} as _level", f"{at} as _block", "null as _exact", *split)

    coarse = sorted({_coarse(period, levels) for period in periods})
    rows = [struct("-1 as _level", "_second as _block", "_at as _exact", *by_dims)]
    rows += [block(level, level, by_dims) for level in levels]
    rows += [block(_ANY + level, level, no_dims) for level in coarse]
    return (
        anchors.dated(activity, event_time, *dims)
        # Never NULL to Spark, so that a null check of a join does not make this a second aggregation.
        .selectExpr(
            *key, *map(quoted, dims), "_at", f"coalesce({seconds_sql('_at', anchors.ntz)}, 0) as _second"
        )
        .selectExpr(*key, f"inline(array({', '.join(rows)}))")
        .groupBy(*anchors.key, "_level", "_block", "_exact", *dims)
        .agg(F.count(F.lit(1)).alias("_n"))
    )


def _run(first: str, end: str) -> str:
    return f"if({first} < {end}, sequence({first}, {end} - 1), array())"


def _coarse(period: Period, levels: range) -> int:
    """The level whose blocks a period is first cut into: one or two, on the top level a few more."""
    return max(level for level in levels if level == 0 or BASE**level <= 4 * period.seconds)


def _parts(anchors: Anchors, periods: Sequence[Period], levels: range) -> DataFrame:
    """(key, ``_at``, ``_period``, ``_level``, ``_block``, ``_low``, ``_high``, ``_whole``): what periods
    are first cut into.

    The full seconds of a period are cut by the blocks of its coarse level, and a part is the
    seconds from ``_low`` up to but without ``_high`` of a block. The second of the anchor itself is a
    whole block of level -1; what is less than its block asks on level _ANY + n for any events.
    """
    key = list(map(quoted, anchors.key))
    choices = ", ".join(
        f"struct({number} as _period, {str(period.direction == 'before').lower()} as _before,"
        f" {period.seconds}L as _length, {_coarse(period, levels)} as _coarse,"
        f" {BASE ** _coarse(period, levels)}L as _size)"
        for number, period in enumerate(periods)
    )
    # A block's first second and the one behind its last, as far as they lie in the period.
    low, high = "greatest(_low, b * _size)", "least(_high, (b + 1) * _size)"
    cut = (
        "transform(if(_low < _high, sequence(floor(_low / _size), floor((_high - 1) / _size)), array()),"
        f" b -> struct(if({high} - {low} = _size, _coarse, _coarse + {_ANY}) as _level, b as _block,"
        f" {low} as _low, {high} as _high, {high} - {low} = _size as _whole))"
    )
    own = (
        "array(struct(-1 as _level, _second as _block, _second as _low, _second + 1 as _high,"
        " true as _whole))"
    )
    return (
        anchors.moments.selectExpr(
            *key, "_at", f"{seconds_sql('_at', anchors.ntz)} as _second", f"inline(array({choices}))"
        )
        .selectExpr(
            *key, "_at", "_period", "_coarse", "_size", "_second",
            "if(_before, _second - _length, _second + 1) as _low",
            "if(_before, _second, _second + _length + 1) as _high",
        )
        .selectExpr(*key, "_at", "_period", f"inline(concat({own}, {cut}))")
    )


def _finer(levels: range) -> str:
    """The fewest blocks below a part's level that make up its seconds, as an array of structs.

    On each level those from ``first`` to ``end`` that are not in a whole block of the level above.
    """
    taken = []
    for level in levels:
        first, end = f"cast(-floor(-_low / {BASE**level}) as bigint)", f"cast(floor(_high / {BASE**level}) as bigint)"
        run = _run(first, end)
        if level + 1 in levels:
            size = BASE ** (level + 1)
            inner = f"{BASE} * cast(-floor(-_low / {size}) as bigint)"
            outer = f"{BASE} * cast(floor(_high / {size}) as bigint)"
            run = f"if({inner} < {outer}, concat({_run(first, inner)}, {_run(outer, end)}), {run})"
        taken.append(f"transform({run}, b -> struct({level} as _level, b as _block))")
    return f"concat({', '.join(taken)})"


def _per_moment(
    anchors: Anchors,
    blocks: DataFrame,
    periods: Sequence[Period],
    dims: Sequence[str],
) -> DataFrame:
    """(key, ``_at``, ``_period``, dims, ``_n``): joint counts of each period of each moment.

    Parts of periods meet the blocks that have events. A whole block's counts are taken as they are; a
    part that is less than its block is put together from smaller ones, which meet the
    blocks once more. All of it is one chain of joins, and both read the same exchange of the blocks.
    """
    key, levels = list(map(quoted, anchors.key)), _levels(periods)
    on = [*anchors.key, "_level", "_block"]
    before = F.array(*[F.lit(period.direction == "before") for period in periods])
    inside = F.when(F.get(before, F.col("_period")), F.col("_exact") <= F.col("_at")).otherwise(
        F.col("_exact") >= F.col("_at")
    )
    known, counted = [f"_dim{i}" for i in range(len(dims))], [*map(quoted, dims), "_n"]
    met = (
        _parts(anchors, periods, levels)
        .join(blocks, on)
        .where(F.col("_exact").isNull() | inside)
        .selectExpr(
            *key, "_at", "_period",
            *[f"if(_whole, {d}, null) as {k}" for d, k in zip(counted, [*known, "_known"], strict=True)],
            f"inline(if(_whole, array(struct({_DONE} as _level, _block)), {_finer(levels)}))",
        )
    )
    return (
        # Reading `_exact` once more makes both joins read one exchange.
        met.join(blocks, on, "left")
        .where("(_known is not null or _n is not null) and _exact is null")
        .selectExpr(
            *key, "_at", "_period",
            *[f"if(_known is null, {d}, {k}) as {d}" for d, k in zip(counted, [*known, "_known"], strict=True)],
        )
        .repartition(*anchors.key, "_at")
        .groupBy(*anchors.key, "_at", "_period", *dims)
        .agg(F.sum("_n").alias("_n"))
    )


def profile_of(
    anchors: Anchors, blocks: DataFrame, periods: Sequence[Period], dims: Sequence[str]
) -> DataFrame:
    """``period_counts`` over the result of ``event_blocks``."""
    named = F.get(F.array(*[F.lit(period.name) for period in periods]), F.col("_period"))
    per_anchor = (
        anchors.with_results(_per_moment(anchors, blocks, periods, dims))
        .groupBy(anchors.id, named.alias(PERIOD), *dims)
        .agg(F.sum("_n").alias("_n"))
    )
    return _marginals(per_anchor, [anchors.id, PERIOD], dims)


def period_counts(
    anchors: DataFrame,
    activity: DataFrame,
    periods: Iterable[Period] = STANDARD_PERIODS,
    *,
    key: str | Sequence[str] = "device_id",
    anchor_id: str = "order_id",
    anchor_time: str = "order_creation_time",
    event_time: str = "polling_creation_time",
    dims: Sequence[str] = DIMS,
) -> DataFrame:
    """``window_profile`` of the ``window_join`` of each period, without the join's pairs.

    Anchor rows that share an id are pooled, an event counting once for each.
    """
    dims, periods = names(dims), check_periods(periods)
    asked = Anchors.against(activity, event_time, anchors, key, anchor_id, anchor_time)
    blocks = event_blocks(asked, activity, event_time, dims, periods)
    return profile_of(asked, blocks, periods, dims)


def each_period(ids: DataFrame, periods: Sequence[Period]) -> DataFrame:
    return ids.select("*", F.explode(F.array(*[F.lit(p.name) for p in periods])).alias(PERIOD))


def multi_period_profile(
    anchors: DataFrame,
    activity: DataFrame,
    periods: Iterable[Period] = STANDARD_PERIODS,
    *,
    anchor_id: str = "order_id",
    **columns,
) -> DataFrame:
    """``period_counts`` for every anchor id: a period without events is one row with NULLs."""
    periods = check_periods(periods)
    # Anchors without an id cannot be told what was counted for them.
    named = anchors.where(all_known([anchor_id]))
    counts = period_counts(named, activity, periods, anchor_id=anchor_id, **columns)
    return each_period(anchors.select(anchor_id).distinct(), periods).join(
        counts, [anchor_id, PERIOD], "left"
    )
