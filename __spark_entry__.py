"""

The given tables hold no polling events and no state log, so both are views
over ``events``, with the same text in Spark and in DuckDB. Events of one user
are hours apart; the ``_wide`` queries use periods that catch more of them.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import anchorctx as ac
from anchorctx.sources import schemas
from anchorctx.sources.csv_export import TIMESTAMP_NTZ
from anchorctx.sources.paths import scratch_folder

try:
    import anchorctx.llm.queries as llm
except ImportError:
    # The optional subpackage, its pipeline, or a library that only they need is not there.
    llm = None

NARROW = {"before": 180, "after": 180, "before_long": 3600}
WIDE = {"before": 21600, "after": 21600, "before_long": 86400}
PERIOD_NAMES = {
    "before": "THREE_MINUTES_BEFORE",
    "after": "THREE_MINUTES_AFTER",
    "before_long": "ONE_HOUR_BEFORE",
}

VIEWS = {
    "anchor": """
        select event_id as anchor_id,
               case when event_id % 50 <> 0 then user_id end as device_id,
               ts as anchor_time
        from events where event_type = 'purchase'
    """,
    "activity": """
        select event_id as seq, user_id as device_id, ts as activity_time,
               case when event_type = 'error'
                    then case when value < 20 then 'GENERIC_ERROR' else 'ECONNABORTED' end
               end as error_code,
               case when event_type <> 'error' then 200
                    when event_id % 2 = 0 then 0 else 401 end as status_code
        from events where event_type in ('view', 'click', 'error')
    """,
    "state_log": """
        select event_id as seq, user_id as device_id, ts as state_time,
               case when event_type = 'signup' then 'ONLINE' else 'OFFLINE' end as status
        from events where event_type in ('signup', 'error')
    """,
}

ANCHOR = {"anchor_id": "anchor_id", "anchor_time": "anchor_time"}
EVENT = {"event_time": "activity_time"}
STATE = {"state_time": "state_time", "status": "status", "seq": "seq"}


def periods(seconds: dict[str, int]) -> list[ac.Period]:
    return [
        ac.Period(PERIOD_NAMES[name], name.split("_")[0], length)
        for name, length in seconds.items()
    ]


def period(name: str, seconds: dict[str, int]) -> ac.Period:
    return periods({name: seconds[name]})[0]


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    return spark.sql(VIEWS[name].replace("from events", "from {events}"), events=events)


# --------------------------------------------------------------------------- queries


def window_join(spark, sf_dir, name, seconds):
    return ac.window_join(
        view(spark, sf_dir, "anchor"),
        view(spark, sf_dir, "activity"),
        period(name, seconds),
        anchor_time="anchor_time",
        event_time="activity_time",
    )


def window_profile_of_join(spark, sf_dir):
    return ac.window_profile(
        window_join(spark, sf_dir, "before_long", NARROW), anchor_id="anchor_id"
    )


def window_counts(spark, sf_dir, name, seconds):
    counts = ac.period_counts(
        view(spark, sf_dir, "anchor"),
        view(spark, sf_dir, "activity"),
        [period(name, seconds)],
        **ANCHOR,
        **EVENT,
    )
    return counts.drop("period_of_time")


def period_profile_keep_all(spark, sf_dir, seconds):
    return ac.keep_all_anchors(
        view(spark, sf_dir, "anchor"),
        window_counts(spark, sf_dir, "before", seconds),
        PERIOD_NAMES["before"],
        anchor_id="anchor_id",
    )


def multi_period_profile(spark, sf_dir, seconds):
    return ac.multi_period_profile(
        view(spark, sf_dir, "anchor"),
        view(spark, sf_dir, "activity"),
        periods(seconds),
        **ANCHOR,
        **EVENT,
    )


def nearest_events(spark, sf_dir, operator):
    return operator(
        view(spark, sf_dir, "anchor"), view(spark, sf_dir, "activity"), **ANCHOR, **EVENT
    )


def state_change_points(spark, sf_dir):
    return ac.state_changes(view(spark, sf_dir, "state_log"), **STATE)


def latest_change_per_device(spark, sf_dir):
    return ac.latest_change(state_change_points(spark, sf_dir), seq="seq")


def state_as_of(spark, sf_dir):
    return ac.state_as_of(
        view(spark, sf_dir, "anchor"), view(spark, sf_dir, "state_log"), **ANCHOR, **STATE
    )


def unbounded_context(spark, sf_dir):
    return ac.unbounded_context(
        view(spark, sf_dir, "anchor"),
        view(spark, sf_dir, "activity"),
        view(spark, sf_dir, "state_log"),
        **ANCHOR,
        **EVENT,
        **STATE,
    )


def context_report(spark, sf_dir, seconds=NARROW):
    return ac.context_report(
        view(spark, sf_dir, "anchor"),
        view(spark, sf_dir, "activity"),
        view(spark, sf_dir, "state_log"),
        periods(seconds),
        **ANCHOR,
        **EVENT,
        **STATE,
    )


def write_csv(df: DataFrame, folder: str) -> None:
    """With a header line and whole times; empty strings stay apart from NULLs."""
    df.write.option("timestampNTZFormat", TIMESTAMP_NTZ).csv(folder, header=True)


def csv_source_explicit_schema(spark, sf_dir):
    """All events through CSV files whose header names say nothing."""
    folder = scratch_folder(spark, "csv-source")
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    write_csv(events.toDF(*[f"c{i}" for i in range(len(events.columns))]), folder)
    schema = (
        "event_id bigint, ts timestamp_ntz, user_id bigint,"
        " event_type string, value double, props string"
    )
    return ac.read_events_csv(spark, folder, schema)


def csv_export_folder(spark, sf_dir):
    path = f"{scratch_folder(spark, 'csv-export')}/report.csv"
    report = context_report(spark, sf_dir, WIDE)
    ac.export_csv(report, path)
    return ac.read_events_csv(spark, path, report.schema)


def context_job(spark, sf_dir):
    """The batch job on CSV files with the standard layouts, its report read back."""
    folder = scratch_folder(spark, "context-job")
    inputs = {
        schemas.ORDERS_FILE: view(spark, sf_dir, "anchor").selectExpr(
            "anchor_id as row_num", "anchor_time", "anchor_id", "device_id"
        ),
        schemas.POLLING_FILE: view(spark, sf_dir, "activity").selectExpr(
            "seq", "activity_time", "device_id", "error_code", "status_code"
        ),
        schemas.CONNECTIVITY_STATUS_FILE: view(spark, sf_dir, "state_log").selectExpr(
            "seq", "state_time", "status", "device_id"
        ),
    }
    for name, rows in inputs.items():
        write_csv(rows, f"{folder}/data/{name}")
    path = ac.run(spark, f"{folder}/data/", f"{folder}/results/")
    result = ac.read_events_csv(
        spark, path, ac.report_from_csv(spark, f"{folder}/data/").schema
    )
    times = [c for c in result.columns if c.endswith("_time")]
    return result.withColumns(
        {c: F.col(c).cast("timestamp_ntz") for c in times if c != "period_of_time"}
    )


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """Every operator, each over the whole of its tables."""
    found: dict[str, Callable[[SparkSession, str], DataFrame]] = {
        "csv_source_explicit_schema": csv_source_explicit_schema,
        "window_profile_of_join": window_profile_of_join,
        "previous_event": partial(nearest_events, operator=ac.previous_event),
        "next_event": partial(nearest_events, operator=ac.next_event),
        "neighbours": partial(nearest_events, operator=ac.neighbours),
        "state_change_points": state_change_points,
        "latest_change_per_device": latest_change_per_device,
        "state_as_of": state_as_of,
        "unbounded_context": unbounded_context,
        "csv_export_folder": csv_export_folder,
        "context_job": context_job,
    }
    for suffix, seconds in (("", NARROW), ("_wide", WIDE)):
        for name in seconds:
            found[f"window_join_{name}{suffix}"] = partial(
                window_join, name=name, seconds=seconds
            )
            found[f"window_counts_{name}{suffix}"] = partial(
                window_counts, name=name, seconds=seconds
            )
        found[f"period_profile_keep_all{suffix}"] = partial(
            period_profile_keep_all, seconds=seconds
        )
        found[f"multi_period_profile{suffix}"] = partial(multi_period_profile, seconds=seconds)
        found[f"context_report{suffix}"] = partial(context_report, seconds=seconds)
    return found | (llm.queries() if llm else {})


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: the context report of every anchor."""
    return context_report(spark, "/root/testdata/sf0.001")


# --------------------------------------------------------------------------- oracle


def _with_views(ctes: dict[str, str], result: str) -> str:
    parts = ",\n".join(f"{name} as ({text})" for name, text in {**VIEWS, **ctes}.items())
    return f"with {parts}\n{result}"


def _pairs(name: str, seconds: dict[str, int]) -> str:
    earlier, later = "p.activity_time", "a.anchor_time"
    if name == "after":
        earlier, later = later, earlier
    return f"""
        select a.device_id, a.anchor_id, a.anchor_time,
               p.seq, p.activity_time, p.error_code, p.status_code
        from anchor a join activity p using (device_id)
        where {earlier} <= {later}
          and date_diff('second', {earlier}, {later}) <= {seconds[name]}
    """


def _profile(pairs: str) -> str:
    """Total and marginals counted apart and put together per seen combination."""
    return f"""
        select c.anchor_id, t.n as count_polling_events,
               c.status_code, s.n as count_status_code,
               c.error_code, e.n as count_error_code
        from (select distinct anchor_id, status_code, error_code from {pairs}) c
        join (select anchor_id, count(*) as n from {pairs} group by anchor_id) t
          on t.anchor_id = c.anchor_id
        join (select anchor_id, status_code, count(*) as n
              from {pairs} group by anchor_id, status_code) s
          on s.anchor_id = c.anchor_id and s.status_code is not distinct from c.status_code
        join (select anchor_id, error_code, count(*) as n
              from {pairs} group by anchor_id, error_code) e
          on e.anchor_id = c.anchor_id and e.error_code is not distinct from c.error_code
    """


def _profile_ctes(names, seconds: dict[str, int]) -> dict[str, str]:
    ctes = {}
    for name in names:
        ctes[f"pairs_{name}"] = _pairs(name, seconds)
        ctes[f"profile_{name}"] = _profile(f"pairs_{name}")
    return ctes


def _keep_all(name: str) -> str:
    return f"""
        select a.anchor_id, '{PERIOD_NAMES[name]}' as period_of_time,
               p.* exclude (anchor_id)
        from anchor a left join profile_{name} p on p.anchor_id = a.anchor_id
    """


def _multi_period(seconds: dict[str, int]) -> dict[str, str]:
    branches = [f"select distinct * from ({_keep_all(name)})" for name in seconds]
    return {
        **_profile_ctes(seconds, seconds),
        "bounded": " union all ".join(branches),
    }


# Each anchor's nearest rows, found by as-of joins. Ids of anchors are unique here.
LAST_EVENT = """
    asof left join activity last
    on a.device_id = last.device_id and a.anchor_time >= last.activity_time
"""
FIRST_EVENT = """
    asof left join activity first
    on a.device_id = first.device_id and a.anchor_time <= first.activity_time
"""
LAST_CHANGE = """
    asof left join change c
    on a.device_id = c.device_id and a.anchor_time >= c.status_change_time
"""
PREVIOUS = "last.activity_time as preceding_event_time"
NEXT = "first.activity_time as following_event_time"
STATE_COLUMNS = """
    c.status as most_recent_status, c.status_change_time as most_recent_status_change_time
"""
# Reports by number, each next to the one numbered before.
CHANGE_CTES = {
    "numbered": """
        select *, row_number() over (partition by device_id order by state_time, seq) as n
        from state_log
    """,
    "compared": """
        select r.device_id, r.state_time, r.seq, r.status,
               if(earlier.status = r.status, null, r.state_time) as status_change_time
        from numbered r
        left join numbered earlier on earlier.device_id = r.device_id and earlier.n = r.n - 1
    """,
    "change": "from compared where status_change_time is not null",
}
CONTEXT_CTES = {
    **CHANGE_CTES,
    "context": f"""
        select a.anchor_id, {STATE_COLUMNS}, {PREVIOUS}, {NEXT}
        from anchor a {LAST_EVENT} {FIRST_EVENT} {LAST_CHANGE}
        where last.device_id is not null or first.device_id is not null
              or c.device_id is not null
    """,
}


def _report(seconds: dict[str, int]) -> str:
    return _with_views(
        {**_multi_period(seconds), **CONTEXT_CTES},
        "select * from bounded left join context using (anchor_id)",
    )


def oracle_sql() -> dict[str, str]:
    """What each query should return, stated in DuckDB SQL without regard to cost."""
    found = {
        "csv_source_explicit_schema": "select * from events",
        "window_profile_of_join": _with_views(
            _profile_ctes(["before_long"], NARROW), "select * from profile_before_long"
        ),
        "previous_event": _with_views(
            {},
            f"""
            select a.anchor_id, {PREVIOUS} from anchor a {LAST_EVENT}
            where last.device_id is not null
            """,
        ),
        "next_event": _with_views(
            {},
            f"""
            select a.anchor_id, {NEXT} from anchor a {FIRST_EVENT}
            where first.device_id is not null
            """,
        ),
        "neighbours": _with_views(
            {},
            f"""
            select a.anchor_id, {PREVIOUS}, {NEXT} from anchor a {LAST_EVENT} {FIRST_EVENT}
            where last.device_id is not null or first.device_id is not null
            """,
        ),
        "state_change_points": _with_views(CHANGE_CTES, "select * from compared"),
        "latest_change_per_device": _with_views(
            CHANGE_CTES,
            """
            select device_id, arg_max(status, status_change_time) as most_recent_status,
                   max(status_change_time) as most_recent_status_change_time
            from change group by device_id
            """,
        ),
        "state_as_of": _with_views(
            CHANGE_CTES,
            f"""
            select a.anchor_id, a.device_id, {STATE_COLUMNS} from anchor a {LAST_CHANGE}
            where c.device_id is not null
            """,
        ),
        "unbounded_context": _with_views(CONTEXT_CTES, "select * from context"),
        "csv_export_folder": _report(WIDE),
        "context_job": _report(NARROW).replace(
            "select * from bounded", "select bounded.* exclude (anchor_id), anchor_id as order_id,"
            " context.* exclude (anchor_id) from bounded"
        ),
    }
    for suffix, seconds in (("", NARROW), ("_wide", WIDE)):
        for name in seconds:
            found[f"window_join_{name}{suffix}"] = _with_views({}, _pairs(name, seconds))
            found[f"window_counts_{name}{suffix}"] = _with_views(
                _profile_ctes([name], seconds), f"select * from profile_{name}"
            )
        found[f"period_profile_keep_all{suffix}"] = _with_views(
            _profile_ctes(["before"], seconds), _keep_all("before")
        )
        found[f"multi_period_profile{suffix}"] = _with_views(
            _multi_period(seconds), "select * from bounded"
        )
        found[f"context_report{suffix}"] = _report(seconds)
    return found | (llm.oracle_sql() if llm else {})
