import random
import re

import duckdb
import numpy as np
import pytest
from tables import AWKWARD, SF_DIR, docs, given

import __spark_entry__ as entry
from anchorctx.llm.decontaminate import (
    Block,
    benchmark_matches,
    decontaminate,
    item_blocks,
    search,
    suffix_array,
    word_hashes,
)

PASSAGE = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu"
ITEMS = [
    (1, PASSAGE),
    (2, "Short ITEM here"),
    (3, ""),
    (4, None),
    (5, "!!! ..."),
    (None, "an item without an id but with quite some words in it anyway"),
    (6, PASSAGE),
    (6, "beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu"),
    (70, "漢字 wörds of another kind"),
]
ROWS = [
    (1, "Before, " + PASSAGE.replace(" ", "--").upper() + "; after"),
    (2, "alpha beta gamma delta epsilon zeta eta theta iota"),
    (3, "a short item here and short Item, HERE"),
    (4, "x " + PASSAGE + " " + PASSAGE + " nu"),
    (5, "ends with alpha beta gamma delta epsilon"),
    (6, "zeta eta theta iota kappa lambda mu begins"),
    (7, "with 漢字 wörds of another kind"),
    (8, "An item without an id but with quite some words in it anyway"),
]


def words(text):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)


def expected(rows, items, window=10):
    out = []
    listed = [(i, words(t)) for i, t in items]
    for d, t in rows:
        w = words(t)
        hit, ids, longest = set(), set(), 0
        for i, v in listed:
            n = min(window, len(v))
            for a in range(len(v) - n + 1) if v else ():
                for b in range(len(w) - n + 1):
                    if w[b : b + n] == v[a : a + n]:
                        hit.update(range(b, b + n))
                        if i is not None:
                            ids.add(str(i))
                        m = n
                        while a + m < len(v) and b + m < len(w) and v[a + m] == w[b + m]:
                            m += 1
                        longest = max(longest, m)
        out.append((d, len(w), len(hit), sorted(ids), longest))
    return sorted(out, key=str)


def measured(table, benchmark, **options):
    found = benchmark_matches(table, benchmark, **options)
    rows = found.select("doc_id", "n_words", "n_hit", "items", "longest").collect()
    return sorted((tuple(r) for r in rows), key=str)


def hashed(texts):
    return [word_hashes([t.encode()])[0] for t in texts]


def items(spark, rows=ITEMS):
    return spark.createDataFrame(rows, "item_id bigint, text string")


@pytest.mark.parametrize("block_words", [1, 20, 1 << 20])
def test_rows_made_by_hand(spark, block_words):
    rows = ROWS + AWKWARD
    found = measured(docs(spark, rows), items(spark), block_words=block_words)
    assert found == expected(rows, ITEMS)


def test_longest_match_and_its_place(spark):
    row = benchmark_matches(docs(spark, [ROWS[3]]), items(spark)).first()
    assert (row.longest, row.longest_at) == (12, 1)
    assert [tuple(s) for s in row.spans] == [(1, 26)]


def test_empty_tables(spark):
    assert measured(docs(spark, []), items(spark)) == []
    assert measured(docs(spark, ROWS), items(spark, [])) == expected(ROWS, [])
    assert decontaminate(docs(spark, ROWS), items(spark, [])).count() == len(ROWS)


def test_affected_documents_go(spark):
    table = docs(spark, ROWS + ROWS)
    left = decontaminate(table, items(spark))
    assert left.columns == table.columns
    assert sorted(r.doc_id for r in left.collect()) == [2, 2, 5, 5, 6, 6]


def test_given_documents_against_sql(spark):
    connection = duckdb.connect()
    for name in ("documents", "benchmark"):
        connection.execute(f"create view {name} as select * from '{SF_DIR}/{name}.parquet'")
    wanted = connection.sql(entry.oracle_sql()["op10_benchmark_hits"])
    df = entry.queries()["op10_benchmark_hits"](spark, str(SF_DIR))
    assert sorted(df.columns) == sorted(wanted.columns)
    assert sorted(map(tuple, df.select(*wanted.columns).collect())) == sorted(wanted.fetchall())


@pytest.mark.parametrize("seed", range(5))
def test_suffix_array(seed):
    choices = random.Random(seed)
    texts = [" ".join(choices.choices("abc", k=choices.randint(0, 60))) for _ in range(12)]
    hashes, _ = word_hashes([t.encode() for t in texts])
    order = suffix_array(hashes, 64)
    assert sorted(order) == list(range(len(hashes)))
    values = [tuple(hashes[i : i + 32].tolist()) for i in order]
    assert values == sorted(values)


def test_word_hashes():
    texts = ["Ab,cd AB", "", "cd\0ab", "é1 é1"]
    hashes, text = word_hashes([t.encode() for t in texts])
    assert text.tolist() == [0, 0, 0, 2, 2, 3, 3]
    assert len(np.unique(hashes)) == 3 and hashes[0] == hashes[2] == hashes[4]


def test_shards_of_one_task(spark, monkeypatch):
    import anchorctx.llm.decontaminate as module

    monkeypatch.setattr(module, "SHARD_BYTES", 50)
    block = module.Block([1], hashed([PASSAGE]), 10)
    found = module.search([t.encode() for _, t in ROWS], [block], 10)
    assert found["items"].tolist() == [["1"], [], [], ["1"], [], [], [], []]
    given(spark)


def test_a_long_item_among_short_ones_takes_no_room_for_each():
    texts = ["w " * 20_000] + ["a few words"] * 2_000
    block = Block([*range(len(texts))], hashed(texts), 10)
    assert len(block.words) <= 26_000 + 10 * len(texts) + 20_000
    found = search([b"x a few words y " + b"w " * 12], [block], 10)
    assert found["longest"].tolist() == [12] and len(found["items"][0]) == len(texts)


@pytest.mark.parametrize("block_words", [1, 7, 64])
def test_long_items_in_pieces(block_words):
    """Matches that go on from piece to piece, with repeated words and several diagonals."""
    choices = random.Random(block_words)
    long = [" ".join(choices.choices(["u", "v"], weights=[9, 1], k=150)) for _ in range(2)]
    rows = [(i, f"x {long[i % 2][a : a + 2 * n]} y {long[0][:40]}") for i, (a, n) in enumerate(
        [(0, 150), (30, 100), (31, 60), (200, 90), (280, 20), (10, 9), (0, 4)])]
    listed = [(1, long[0]), (2, "u v u"), (3, long[1])]
    made = list(item_blocks([(i, t.encode()) for i, t in listed], 10, block_words))
    assert len(made) > 3
    found = search([t.encode() for _, t in rows], made, 10)
    got = [
        (d, f.n_words, sum(s["end"] - s["start"] for s in f.spans), sorted(set(f.items)), f.longest)
        for (d, _), f in zip(rows, found.itertuples(), strict=True)
    ]
    assert got == expected(rows, listed)


def test_a_benchmark_of_many_blocks_reads_the_documents_once(spark):
    read = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            read.add(len(batch))
            yield batch

    choices = random.Random(3)
    rows = [(i, " ".join(choices.choices("abcdefgh", k=30))) for i in range(40)]
    listed = [(i, t) for i, t in rows[:20]]
    table = docs(spark, rows)
    found = measured(table.mapInPandas(counted, table.schema), items(spark, listed), block_words=30)
    assert read.value == len(rows)
    assert found == expected(rows, listed)


def test_an_item_of_ten_megabytes():
    choices = random.Random(4)
    vocabulary = [f"w{i}" for i in range(3000)]
    book = " ".join(choices.choices(vocabulary, k=1_900_000))
    assert len(book) > 10_000_000
    part = book[3_000_000:5_500_000]
    n = len(part.split()) - 2
    blocks = item_blocks([(1, book.encode())], 10, 1 << 18)
    row = search([b"begin " + part.split(" ", 1)[1].rsplit(" ", 1)[0].encode() + b" end"], blocks, 10).iloc[0]
    assert (row.n_words, row.longest, row.longest_at, row["items"][0]) == (n + 2, n, 1, "1")
    assert row.spans == [{"start": 1, "end": n + 1}]
