"""Small tables: the given documents, and rows made to be awkward."""

from pathlib import Path

SF_DIR = Path("/root/testdata/sf0.001")
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
# Names that operators use for columns of their own.
CLASHING = (
    "score double, size bigint, key string, component_id bigint, fingerprint string, line string,"
    " ids string, band string, row_key string, shard int, label string, held_out string,"
    " items string, _row_key string, chunk string, words string"
)


def given(spark, name="documents"):
    return spark.read.parquet(str(SF_DIR / f"{name}.parquet"))


def docs(spark, rows):
    """(doc_id, text) rows as a documents table with further columns of clashing names."""
    more = [x.split()[0] for x in CLASHING.split(", ")]
    table = spark.createDataFrame(
        [(d, t, "en", "s", None if t is None else len(t)) for d, t in rows], SCHEMA
    )
    return table.selectExpr("*", *[f"'x' as {name}" for name in more])


AWKWARD = [
    (1, None),
    (2, ""),
    (3, "one"),
    (4, " \t\n\x0b\f\r "),
    (None, "a text without an id, of some words more than ten in all, it seems"),
    (5, "The same text twice, with the same id, for once and for all the others"),
    (5, "The same text twice, with the same id, for once and for all the others"),
    (6, "The same text twice, with the same id, for once and for all the others"),
    (6, "Another text of the same id"),
    (7, "ünïcödé wörds 漢字 𝒳 and more\nlines of them\nlines of them"),
    (8, "x" * 30_000),
    (9, "word " * 9_000),
    (10, None),
    (-3, "A negative id\nwith lines"),
]
