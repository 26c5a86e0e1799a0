"""What the plans must look like to hold at scale."""

import re

import pytest

import __spark_entry__ as entry

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture
def plan(spark):
    """Physical plan as a cluster would get it, where no table is small."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.enabled": "false",
    }
    before = {name: spark.conf.get(name) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)

    def of(name):
        df = entry.queries()[name](spark, SF_DIR)
        return df._jdf.queryExecution().executedPlan().toString()

    yield of
    for name, value in before.items():
        spark.conf.set(name, value)


OTHERS = set(entry.llm.queries()) if entry.llm else set()
NO_FILES = sorted(
    n for n in set(entry.queries()) - OTHERS if "csv" not in n and "job" not in n
)


@pytest.mark.parametrize("name", NO_FILES)
def test_no_pairs_beyond_equal_keys_and_no_python(plan, name):
    text = plan(name)
    for operator in ("CartesianProduct", "NestedLoop", "BroadcastExchange", "Python", "Pandas"):
        assert operator not in text
    assert "SinglePartition" not in text


def test_each_history_is_scanned_once_in_the_report(plan):
    scans = [line for line in plan("context_report").splitlines() if "FileScan" in line]
    assert sum("(view,click,error)" in line for line in scans) == 1
    assert sum("(signup,error)" in line for line in scans) == 1
    # Distinct moments, the rows that have one, those that have none.
    assert sum("purchase" in line for line in scans) == 3
    for line in scans:
        assert "IsNotNull(event_type)" in line or "In(event_type" in line
        assert "props" not in re.search(r"ReadSchema: (\S+)", line).group(1)


@pytest.mark.parametrize("name", ["context_report", "neighbours", "state_as_of"])
def test_windows_over_a_whole_key_see_one_row_per_chunk(plan, name):
    """Such a window may only read the aggregation per (key, chunk)."""
    lines = plan(name).splitlines()
    found = 0
    for number, line in enumerate(lines):
        window = re.search(r"Window \[.*windowspecdefinition\((device_id#\w+), (\S+)", line)
        if not window or not window.group(2).startswith("_chunk#"):
            continue
        if " ASC" not in line.split(window.group(2))[1][:5] and " DESC" not in line.split(
            window.group(2)
        )[1][:6]:
            continue
        found += 1
        below = next(x for x in lines[number + 1 :] if "Aggregate" in x or "Union" in x)
        assert "Aggregate" in below
    assert found


def test_events_are_added_up_before_they_are_shuffled(plan):
    lines = plan("context_report").splitlines()
    for number, line in enumerate(lines):
        if "FileScan" in line and "purchase" not in line:
            above = [re.sub(r"^[\s:+-]*(\*\(\d+\) )?", "", x) for x in lines[:number][::-1]]
            first = next(x for x in above if x.startswith(("HashAggregate", "Exchange")))
            assert first.startswith("HashAggregate")


def test_state_changes_scan_the_log_once(plan):
    text = plan("state_change_points")
    assert sum("FileScan" in line for line in text.splitlines()) == 1
    assert "ReusedExchange" in text


def test_chunks_do_not_follow_the_periods(plan):
    """The wide report looks a day back, its histories are cut into hours all the same."""
    for name in ("context_report", "context_report_wide"):
        chunks = set(re.findall(r"/ (\d+)(?:\.0)?\b[^,]*?\), 0\) AS _chunk", plan(name)))
        assert chunks == {"3600"}
