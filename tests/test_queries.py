"""Every registered query against its SQL statement in DuckDB, on the given tables."""

import importlib.util
import sys
from collections import Counter
from pathlib import Path

import pytest

import __spark_entry__ as entry

SF_DIR = Path("/root/testdata/sf0.001")
TYPES = {
    "BIGINT": "bigint",
    "INTEGER": "int",
    "VARCHAR": "string",
    "DOUBLE": "double",
    "TIMESTAMP": "timestamp_ntz",
}

# Those of the subpackage that may be absent have tests of their own.
OTHERS = set(entry.llm.queries()) if entry.llm else set()
NAMES = sorted(set(entry.queries()) - OTHERS)

duckdb = pytest.importorskip("duckdb")
pytestmark = pytest.mark.skipif(not SF_DIR.exists(), reason="no test tables")


@pytest.fixture(scope="module")
def oracle():
    connection = duckdb.connect()
    for path in SF_DIR.glob("*.parquet"):
        connection.execute(f"create view {path.stem} as select * from '{path}'")
    return connection


def test_each_query_has_an_oracle():
    assert set(NAMES) == set(entry.oracle_sql()) - OTHERS


@pytest.mark.parametrize("name", NAMES)
def test_query(spark, oracle, name):
    df = entry.queries()[name](spark, str(SF_DIR))
    expected = oracle.sql(entry.oracle_sql()[name])
    columns = sorted(df.columns)
    assert columns == sorted(expected.columns)
    place = [expected.columns.index(c) for c in columns]
    assert [df.schema[c].dataType.simpleString() for c in columns] == [
        TYPES[str(expected.types[i])] for i in place
    ]
    assert Counter(tuple(row) for row in df.select(*columns).collect()) == Counter(
        tuple(row[i] for i in place) for row in expected.fetchall()
    )


def test_entry(spark):
    assert entry.entry(spark).count() == 606


def test_a_library_that_only_the_optional_part_needs_may_be_missing(monkeypatch):
    for name in list(sys.modules):
        if name.startswith("anchorctx.llm") or name == "corpus_pipeline":
            monkeypatch.delitem(sys.modules, name)
    for name in ("public_tokenizers", "xxhash", "regex"):
        monkeypatch.setitem(sys.modules, name, None)
    spec = importlib.util.spec_from_file_location("entry_alone", entry.__file__)
    alone = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(alone)
    assert alone.llm is None
    assert set(alone.queries()) == set(alone.oracle_sql()) >= {"context_report", "context_job"}
