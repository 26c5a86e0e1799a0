"""The batch job on three small CSV files, each order showing one case."""

import csv
from pathlib import Path

import anchorctx as ac

ORDERS = """,order_creation_time,order_id,device_id
0,2021-05-04 08:00:00,11,
1,2021-05-04 08:00:00,12,dev-a
2,2021-05-04 08:00:00,13,dev-b
3,2021-05-04 08:00:00,14,dev-c
4,2021-05-04 08:00:00,15,dev-d
"""
POLLING = """,creation_time,device_id,error_code,status_code
0,2021-05-04 07:10:00.500,dev-a,,200
1,2021-05-04 07:57:30.250,dev-a,GENERIC_ERROR,401
2,2021-05-04 07:58:30.250,dev-a,,200
3,2021-05-04 08:02:59.999,dev-a,,200
4,2021-05-04 06:00:00.000,dev-b,,200
5,2021-05-04 09:00:00.000,dev-b,ECONNABORTED,0
6,2021-05-04 08:03:00.999,dev-c,ECONNABORTED,0
7,2021-05-04 07:00:00.000,dev-d,,200
"""
STATES = """,creation_time,status,device_id
0,2021-05-04 05:00:00.001,OFFLINE,dev-a
1,2021-05-04 05:00:00.002,ONLINE,dev-a
2,2021-05-04 07:00:00.000,ONLINE,dev-a
3,2021-05-04 08:00:00.001,OFFLINE,dev-a
4,2021-05-04 08:00:01.000,ONLINE,dev-b
5,2021-05-04 08:00:00.000,OFFLINE,dev-d
"""
T = "2021-05-04T{}000+02:00".format
BEFORE, AFTER, HOUR = "THREE_MINUTES_BEFORE", "THREE_MINUTES_AFTER", "ONE_HOUR_BEFORE"
NONE = ("", "", "", "", "")
# State, time of its change, previous event, next event.
AROUND = {
    "11": ("", "", "", ""),
    "12": ("ONLINE", T("05:00:00.002"), T("07:58:30.250"), T("08:02:59.999")),
    "13": ("", "", T("06:00:00.000"), T("09:00:00.000")),
    "14": ("", "", "", T("08:03:00.999")),
    "15": ("OFFLINE", T("08:00:00.000"), T("07:00:00.000"), ""),
}
COUNTS = [
    ("11", BEFORE, *NONE),
    ("11", AFTER, *NONE),
    ("11", HOUR, *NONE),
    ("12", BEFORE, "2", "401", "1", "GENERIC_ERROR", "1"),
    ("12", BEFORE, "2", "200", "1", "", "1"),
    ("12", AFTER, "1", "200", "1", "", "1"),
    ("12", HOUR, "3", "401", "1", "GENERIC_ERROR", "1"),
    ("12", HOUR, "3", "200", "2", "", "2"),
    ("13", BEFORE, *NONE),
    ("13", AFTER, *NONE),
    ("13", HOUR, *NONE),
    ("14", BEFORE, *NONE),
    ("14", AFTER, "1", "0", "1", "ECONNABORTED", "1"),
    ("14", HOUR, *NONE),
    ("15", BEFORE, *NONE),
    ("15", AFTER, *NONE),
    ("15", HOUR, "1", "200", "1", "", "1"),
]
HEADER = [
    "order_id",
    "most_recent_status",
    "most_recent_status_change_time",
    "preceding_event_time",
    "following_event_time",
    "period_of_time",
    "count_polling_events",
    "status_code",
    "count_status_code",
    "error_code",
    "count_error_code",
]


def test_job_from_csv_to_csv(spark, tmp_path, clock):
    clock("+02:00")
    data = tmp_path / "data"
    data.mkdir()
    for name, text in (
        ("orders", ORDERS),
        ("polling", POLLING),
        ("connectivity_status", STATES),
    ):
        (data / f"{name}.csv").write_text(text)
    path = ac.run(spark, f"{data}/", str(tmp_path / "results"))
    assert path == f"{tmp_path}/results/analysis_data.csv"
    rows = []
    for part in Path(path).glob("part-*.csv"):
        with open(part) as report:
            header, *found = csv.reader(report)
        assert header == HEADER
        rows += found
    assert sorted(map(tuple, rows)) == sorted(
        (row[0], *AROUND[row[0]], *row[1:]) for row in COUNTS
    )
    types = [f.dataType.simpleString() for f in ac.report_from_csv(spark, str(data)).schema]
    assert types == [
        "bigint", "string", "timestamp", "timestamp", "timestamp", "string",
        "bigint", "int", "bigint", "string", "bigint",
    ]


def write(folder, orders, polling, states):
    folder.mkdir()
    for name, text in (
        ("orders", orders),
        ("polling", polling),
        ("connectivity_status", states),
    ):
        (folder / f"{name}.csv").write_text(text)
    return str(folder)


def test_ids_beyond_32_bits_keep_their_counts_and_state(spark, tmp_path):
    data = write(
        tmp_path / "data",
        ",t,id,d\n1,2021-05-04 08:00:00,3000000001,a\n2,2021-05-04 09:00:00,3000000002,a\n",
        ",t,d,e,s\n4000000001,2021-05-04 07:59:00,a,,200\n",
        ",t,s,d\n4000000002,2021-05-04 07:00:00,ONLINE,a\n",
    )
    rows = ac.report_from_csv(spark, data).where("period_of_time = 'ONE_HOUR_BEFORE'").collect()
    assert sorted((r.order_id, r.count_polling_events, r.most_recent_status) for r in rows) == [
        (3000000001, 1, "ONLINE"),
        (3000000002, None, "ONLINE"),
    ]


def test_microseconds_decide(spark, tmp_path):
    """Times that differ by a microsecond are before and after, from file to file."""
    data = write(
        tmp_path / "data",
        ",t,id,d\n1,2021-05-04 08:00:00.000500,1,a\n",
        ",t,d,e,s\n1,2021-05-04 08:00:00.000499,a,,200\n2,2021-05-04 08:00:00.000501,a,,401\n",
        ",t,s,d\n1,2021-05-04 08:00:00.000500,ONLINE,a\n2,2021-05-04 08:00:00.000501,OFFLINE,a\n",
    )
    path = ac.run(spark, data, str(tmp_path / "results"))
    schema = ac.report_from_csv(spark, data).schema
    report = ac.read_events_csv(spark, path, schema)
    assert report.select("most_recent_status").distinct().collect() == [("ONLINE",)]
    times = report.selectExpr("string(preceding_event_time)", "string(following_event_time)")
    assert times.distinct().collect() == [
        ("2021-05-04 08:00:00.000499", "2021-05-04 08:00:00.000501")
    ]
    counts = report.select("period_of_time", "status_code", "count_polling_events").collect()
    assert sorted(map(tuple, counts)) == [
        (HOUR, 200, 1), (AFTER, 401, 1), (BEFORE, 200, 1)
    ]


def test_other_schemas(spark, tmp_path):
    data = write(
        tmp_path / "data",
        "t,id,d\n2021-05-04 08:00:00,x1,a\n",
        "t,d,page\n2021-05-04 07:59:00,a,home\n",
        "n,t,s,d\n1,2021-05-04 07:00:00,ONLINE,a\n",
    )
    row = ac.report_from_csv(
        spark,
        data,
        orders="order_creation_time timestamp, order_id string, device_id string",
        polling="polling_creation_time timestamp, device_id string, page string",
        dims=["page"],
    ).where("period_of_time = 'THREE_MINUTES_BEFORE'").first()
    assert (row.order_id, row.page, row.count_page) == ("x1", "home", 1)


def test_each_file_is_parsed_once(spark, tmp_path, monkeypatch):
    """The report reads tables; the files are read by three writes, and the tables are gone afterwards."""
    from pathlib import Path

    from anchorctx.plans import job

    data = write(
        tmp_path / "data",
        ",t,id,d\n1,2021-05-04 08:00:00,1,a\n",
        ",t,d,e,s\n1,2021-05-04 07:59:00,a,,200\n",
        ",t,s,d\n1,2021-05-04 07:00:00,ONLINE,a\n",
    )
    seen = {}

    def exported(report, path):
        seen["plan"] = report._jdf.queryExecution().executedPlan().toString()
        seen["files"] = report.inputFiles()

    monkeypatch.setattr(job, "export_csv", exported)
    job.run(spark, data, str(tmp_path / "results"))
    assert "FileScan csv" not in seen["plan"] and "FileScan parquet" in seen["plan"]
    folders = {Path(f.removeprefix("file:")).parent for f in seen["files"]}
    assert len(folders) == 3 and not any(f.exists() for f in folders)
