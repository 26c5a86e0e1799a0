"""CSV in and out."""

from datetime import datetime
from pathlib import Path
from types import SimpleNamespace

import pytest

import anchorctx as ac
from anchorctx.sources.paths import scratch_folder

SCHEMA = "row_num int, t timestamp, code string"


def files(folder):
    return sorted(p.name for p in Path(folder).iterdir() if not p.name.endswith(".crc"))


def test_declared_schema_and_bad_fields(spark, tmp_path):
    source = tmp_path / "in.csv"
    source.write_text(
        ",when,wrong\n"
        "1,2020-01-01 00:00:00.123,A\n"
        "x,2020-01-01 00:00:01,B\n"
        '3,no time,""\n'
        "4,2020-01-01 00:00:02\n"
        "5,,"
    )
    df = ac.read_events_csv(spark, str(source), SCHEMA).selectExpr(
        "row_num", "cast(t as timestamp_ntz) t", "code"
    )
    assert {tuple(r) for r in df.collect()} == {
        (1, datetime(2020, 1, 1, 0, 0, 0, 123000), "A"),
        (None, datetime(2020, 1, 1, 0, 0, 1), "B"),
        (3, None, None),
        (4, datetime(2020, 1, 1, 0, 0, 2), None),
        (5, None, None),
    }


def small(spark, n=3):
    return spark.range(n).selectExpr(
        "cast(id as int) as row_num",
        "timestamp'2020-01-01 00:00:00.123456' as t",
        "case id when 0 then '' when 1 then null else 'c' end as code",
    )


def lines(folder):
    return [p.read_text().splitlines() for p in sorted(Path(folder).glob("part-*.csv"))]


def test_export_replaces_and_keeps_microseconds(spark, tmp_path):
    target = tmp_path / "out" / "report.csv"
    for n in (1, 3):
        ac.export_csv(small(spark, n).repartition(2), str(target))
    parts = lines(target)
    assert {part[0] for part in parts} == {"row_num,t,code"}
    assert sorted(line for part in parts for line in part[1:]) == [
        "0,2020-01-01T00:00:00.123456Z,",
        "1,2020-01-01T00:00:00.123456Z,",
        "2,2020-01-01T00:00:00.123456Z,c",
    ]
    assert files(target.parent) == ["report.csv"]
    back = ac.read_events_csv(spark, str(target), SCHEMA)
    assert back.where("t = timestamp'2020-01-01 00:00:00.123456'").count() == 3


def test_times_without_zone_keep_microseconds(spark, tmp_path):
    target = str(tmp_path / "report.csv")
    ac.export_csv(spark.sql("select timestamp_ntz'2020-01-01 00:00:00.000001' t"), target)
    back = ac.read_events_csv(spark, target, "t timestamp_ntz")
    assert back.first()[0] == datetime(2020, 1, 1, 0, 0, 0, 1)


def test_session_zone_and_format_are_written(spark, tmp_path, clock):
    clock("+01:00")
    target = tmp_path / "report.csv"
    df = spark.sql("select timestamp'2020-02-26 09:29:19.784' t")
    ac.export_csv(df, str(target))
    assert lines(target) == [["t", "2020-02-26T09:29:19.784000+01:00"]]
    ac.export_csv(df, str(target), timestamp_format="yyyy-MM-dd'T'HH:mm:ss.SSSXXX")
    assert lines(target) == [["t", "2020-02-26T09:29:19.784+01:00"]]


def test_empty_result_is_a_header(spark, tmp_path):
    target = tmp_path / "report.csv"
    ac.export_csv(small(spark).where("false"), str(target))
    assert lines(target) == [["row_num,t,code"]]


def test_scratch_folder_lies_in_the_shared_folder(spark):
    shared = spark.conf.get("spark.checkpoint.dir")
    assert scratch_folder(spark, "x").startswith(shared.rstrip("/") + "/x-")


def test_scratch_folder_without_the_setting_is_in_the_warehouse():
    """The setting cannot be taken from a running session, so one is made up."""
    settings = {"spark.sql.warehouse.dir": "hdfs://store/warehouse/"}
    session = SimpleNamespace(conf=settings)
    assert scratch_folder(session, "x").startswith("hdfs://store/warehouse/_scratch/x-")


def test_a_failed_write_leaves_the_old_result(spark, tmp_path):
    target = tmp_path / "report.csv"
    ac.export_csv(spark.sql("select 1 as n"), str(target))
    failing = spark.range(0, 100, 1, 4).selectExpr("if(id = 99, raise_error('stop'), id) as n")
    with pytest.raises(Exception, match="stop"):
        ac.export_csv(failing, str(target))
    assert lines(target) == [["n", "1"]]
    assert files(target.parent) == ["report.csv"]


def test_a_result_that_cannot_be_published_leaves_the_old_one(spark, tmp_path, monkeypatch):
    from anchorctx.sources import csv_export

    target = tmp_path / "report.csv"
    ac.export_csv(spark.sql("select 1 as n"), str(target))
    publish = csv_export.publish
    # The new folder is gone when it is to be renamed.
    monkeypatch.setattr(
        csv_export, "publish", lambda s, new, path: (csv_export.remove(s, new), publish(s, new, path))
    )
    with pytest.raises(OSError, match="rename"):
        ac.export_csv(spark.sql("select 2 as n"), str(target))
    assert lines(target) == [["n", "1"]]
    assert files(target.parent) == ["report.csv"]


def test_scratch_folder_of_one_machine_is_refused_on_a_cluster():
    session = SimpleNamespace(
        conf={"spark.sql.warehouse.dir": "file:/home/me/spark-warehouse"},
        sparkContext=SimpleNamespace(master="yarn"),
    )
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch_folder(session, "x")
