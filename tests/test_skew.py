"""A device with a third of all rows, copies of one event, and one id for many anchors."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

import anchorctx as ac
from frames import bag

PERIODS = [ac.Period("b", "before", 600), ac.Period("a", "after", 120)]


@pytest.fixture(scope="module")
def tables(spark):
    def rows(n, shift):
        """Device 0 has each third row; each tenth row is a copy of one moment."""
        return spark.range(n).select(
            F.expr("if(id % 3 = 0, 0, hash(id) % 50)").alias("device_id"),
            F.expr(
                "timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, 0, 0,"
                f" if(id % 10 = 0, 7200, abs(hash(id, {shift})) % 200000))"
            ).alias("t"),
            "id",
        )

    anchors = rows(3000, 1).selectExpr(
        "if(id % 4 = 0, 7, id) as order_id", "device_id", "t as order_creation_time"
    )
    activity = rows(9000, 2).selectExpr(
        "device_id",
        "t as polling_creation_time",
        "cast(id % 2 as int) as status_code",
        "if(id % 5 = 0, 'X', null) as error_code",
    )
    log = rows(4000, 3).selectExpr(
        "device_id",
        "id as row_num",
        "t as cs_creation_time",
        "if(hash(id, 9) % 3 = 0, 'ON', 'OFF') as status",
    )
    for name, df in (("a", anchors), ("p", activity), ("s", log)):
        df.createOrReplaceTempView(f"skewed_{name}")
    return anchors, activity, log


def test_counts_equal_the_counted_pairs(spark, tables):
    anchors, activity, _ = tables
    counts = ac.period_counts(anchors, activity, PERIODS)
    pairs = spark.sql(
        """
        select order_id, period, status_code, error_code, count(*) n
        from skewed_a join skewed_p using (device_id)
        join values ('b', -1, 600), ('a', 1, 120) as v(period, sign, length)
        where sign * timestampdiff(second, order_creation_time, polling_creation_time)
              between 0 and length
        group by all
        """
    )
    total = pairs.groupBy("order_id", "period").agg(F.sum("n"))
    by_status = pairs.groupBy("order_id", "period", "status_code").agg(F.sum("n"))
    got = counts.withColumnRenamed("period_of_time", "period")
    assert bag(got.select("order_id", "period", "count_polling_events").distinct()) == bag(total)
    assert bag(
        got.select("order_id", "period", "status_code", "count_status_code").distinct()
    ) == bag(by_status)
    assert bag(got, "order_id", "period", "status_code", "error_code") == Counter(
        bag(pairs, "order_id", "period", "status_code", "error_code")
    )


def test_neighbours_and_state(spark, tables):
    anchors, activity, log = tables
    expected = spark.sql(
        """
        select order_id,
               max(case when polling_creation_time <= order_creation_time
                        then polling_creation_time end) p,
               min(case when polling_creation_time >= order_creation_time
                        then polling_creation_time end) f
        from skewed_a join skewed_p using (device_id) group by order_id
        """
    )
    assert bag(ac.neighbours(anchors, activity, chunk_seconds=600)) == bag(expected)
    expected = spark.sql(
        """
        with c as (
          select *, lag(status) over (partition by device_id
                                      order by cs_creation_time, row_num) before
          from skewed_s)
        select order_id, device_id,
               max(struct(cs_creation_time t, row_num, status)).status st,
               max(cs_creation_time) since
        from skewed_a join c using (device_id)
        where cs_creation_time <= order_creation_time and not status <=> before
        group by order_id, device_id
        """
    )
    assert bag(ac.state_as_of(anchors, log, chunk_seconds=600)) == bag(expected)


def test_no_group_of_the_windows_grows_with_copies(tables):
    """What a window partition holds is bounded by the moments of a chunk."""
    from anchorctx.operators.asof import Anchors
    from anchorctx.operators.profile import event_blocks

    anchors, activity, _ = tables
    asked = Anchors.against(
        activity,
        "polling_creation_time",
        anchors,
        "device_id",
        "order_id",
        "order_creation_time",
        600,
    )
    dims = ["status_code", "error_code"]
    periods = [ac.Period("p", "before", 600)]
    counts = event_blocks(asked, activity, "polling_creation_time", dims, periods).where("_level = -1")
    hours = F.expr("_block div 600")
    largest = counts.groupBy("device_id", hours).count().agg(F.max("count")).first()[0]
    assert largest <= 600 * 4
    assert counts.agg(F.sum("_n")).first()[0] == activity.count()
    assert asked.moments.groupBy("device_id", "_chunk").count().agg(F.max("count")).first()[0] <= 600


def met_rows(spark, anchors, activity, periods, dims):
    """Block rows that the profile's joins of anchors and activity meet, and the largest group."""
    from anchorctx.operators import profile
    from anchorctx.operators.asof import Anchors

    asked = Anchors.against(activity, "t", anchors, "device_id", "id", "t")
    levels = profile._levels(periods)
    blocks = profile.event_blocks(asked, activity, "t", dims, periods)
    parts = profile._parts(asked, periods, levels)
    key = ["device_id", "_level", "_block"]
    cut = parts.where("not _whole").join(blocks, key, "left_semi")
    finer = cut.selectExpr("device_id", "_at", "_period", f"inline({profile._finer(levels)})")
    wanted = parts.select(*finer.columns).unionByName(finer)
    return (
        wanted.join(blocks, key).count(),
        wanted.groupBy(*key).count().agg(F.max("count")).first()[0],
        blocks.groupBy(*key).count().agg(F.max("count")).first()[0],
        wanted.groupBy("device_id", "_at", "_period").count().agg(F.max("count")).first()[0],
    )


def busy(spark, n, step, page):
    """One device, a row each ``step`` milliseconds."""
    return spark.range(n).selectExpr(
        "1 as device_id", "id",
        f"timestamp_millis(1700000000000 + id * {step})::timestamp_ntz as t",
        f"{page} as page",
    )


def test_rows_met_follow_the_result_with_many_dim_values(spark):
    """An hour, 1,000 anchors, 2,000 events with a page each, a period of a second."""
    anchors, activity = busy(spark, 1000, 3600, "0"), busy(spark, 2000, 1800, "id")
    period = [ac.Period("s", "before", 1)]
    pairs = ac.window_join(
        anchors.select("device_id", "id", "t"),
        activity.select("device_id", "page", F.col("t").alias("e")),
        period[0],
        anchor_time="t",
        event_time="e",
    ).count()
    rows = met_rows(spark, anchors.drop("page"), activity.drop("id"), period, ["page"])
    assert pairs / 4 <= rows[0] <= 2 * pairs


def test_no_group_grows_with_the_period(spark):
    """One device with 20,000 times over 30 days: periods of an hour and of 30 days."""
    anchors, activity = busy(spark, 2000, 1296000, "0"), busy(spark, 20000, 129600, "id % 3")
    hour, month = (
        met_rows(spark, anchors.drop("page"), activity.drop("id"), [ac.Period("p", "before", n)], ["page"])
        for n in (3600, 30 * 86400)
    )
    # A block has a row per combination of dims; what one moment asks for grows by levels.
    assert month[2] <= 3 and hour[2] <= 3
    assert hour[3] <= 14 * 4 + 17
    assert month[3] <= 14 * 7 + 17
