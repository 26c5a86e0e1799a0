import random

import numpy as np
import pandas as pd
import pytest
from tables import AWKWARD, SF_DIR, docs, given

import __spark_entry__ as entry
from anchorctx.llm.common import row_key
from anchorctx.llm.line_dedup import (
    SHINGLE,
    Shingled,
    _maybe_joined,
    _met,
    band_hashes,
    dedup_lines,
    line_components,
    shingle_ids,
    sketches,
)

BLANK = " \t\v\f\r"


def shingles(line):
    return {line[i : i + SHINGLE] for i in range(max(1, len(line) - SHINGLE + 1))}


def components(lines):
    """Of all pairs of lines, by their sets of shingles."""
    lines = sorted(set(lines))
    sets = [shingles(x) for x in lines]
    root = list(range(len(lines)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(lines)):
        for j in range(i):
            small, large = sorted((len(sets[i]), len(sets[j])))
            if small >= 0.8 * large:
                both = len(sets[i] & sets[j])
                if both >= 0.8 * (small + large - both) and find(i) != find(j):
                    root[find(i)] = find(j)
    return {x: find(i) for i, x in enumerate(lines)}


def expected(rows, keys):
    """What is left of each text if the first line of each component stays."""
    places = sorted(
        {
            (d is None, d or 0, keys[d, t], at, line)
            for d, t in rows
            for at, line in enumerate((t or "").split("\n"))
            if line.strip(BLANK)
        }
    )
    part = components(p[4] for p in places)
    first, gone = set(), set()
    for p in places:
        (gone.add(p[:4]) if part[p[4]] in first else first.add(part[p[4]]))
    return sorted(
        (
            (d, t and "\n".join(
                line for at, line in enumerate(t.split("\n"))
                if (d is None, d or 0, keys[d, t], at) not in gone
            ))
            for d, t in rows
        ),
        key=str,
    )


def keys(table):
    return {(r[0], r[1]): r[2] for r in table.select("doc_id", "text", row_key("doc_id", "text")).collect()}


def measured(table):
    return sorted(((r.doc_id, r.text) for r in dedup_lines(table).collect()), key=str)


LINE = "It was a bright cold day in April, and the clocks were striking thirteen in town %s"
ROWS = [
    (1, LINE % "one" + "\nshort\n\nits own line of text"),
    (2, LINE % "two" + "\nshort\n \nanother line that stands alone here"),
    (3, LINE % "two" + "\nSHORT\nits own line of text\nits own line of text"),
    (4, "\n\n"),
    (0, "shorts"),
    (None, LINE % "three"),
]


def test_rows_made_by_hand(spark):
    table = docs(spark, ROWS)
    found = measured(table)
    assert found == expected(ROWS, keys(table))
    texts = dict(found)
    assert texts[1].startswith("It was") and not texts[2].startswith("It was")
    assert texts[None] == "" and texts[3] == "SHORT" and texts[4] == "\n\n"


def test_awkward_rows(spark):
    rows = AWKWARD + ROWS
    table = docs(spark, rows)
    assert measured(table) == expected(rows, keys(table))
    assert dedup_lines(table).columns == table.columns
    assert dedup_lines(docs(spark, [])).count() == 0


def test_given_documents(spark):
    table = given(spark)
    rows = [(r.doc_id, r.text) for r in table.collect()]
    wanted = expected(rows, keys(table))
    found = measured(table)
    assert sum(a != b for a, b in zip(found, wanted, strict=True)) == 0


def test_query(spark):
    found = entry.queries()["op6_line_dedup"](spark, str(SF_DIR))
    table = given(spark)
    left = {r.doc_id: r.text for r in dedup_lines(table).collect()}
    for r in found.collect():
        lines = [x for x in left[r.doc_id].split("\n") if x.strip(BLANK)]
        assert r.n_kept == len(lines)
        assert r.n_lines - r.n_kept == len(r.removed.split(",") if r.removed else [])


def test_variants_of_one_line_in_small_blocks(spark):
    """Chains of variants: neighbours are near each other, the ends are not."""
    choices = random.Random(5)
    word = lambda: "".join(choices.choices("abcdefgh", k=6))
    rows, at = [], 0
    for _ in range(4):
        line = [word() for _ in range(30)]
        for _ in range(60):
            line[choices.randrange(30)] = word()
            rows.append((at, " ".join(line)))
            at += 1
    found = line_components(docs(spark, rows), block=8)
    parts = {r.node: r.component for r in found.collect()}
    import xxhash

    signed = lambda x: x - (1 << 64) if x >> 63 else x
    wanted, got = {}, {}
    for line, part in components(t for _, t in rows).items():
        key = signed(xxhash.xxh64_intdigest(line.encode(), 42))
        wanted.setdefault(part, set()).add(line)
        got.setdefault(parts.get(key, line), set()).add(line)
    assert sorted(map(sorted, wanted.values())) == sorted(map(sorted, got.values()))


@pytest.mark.parametrize("length", [24, 60, 200])
def test_recall_of_the_bands(length):
    """Pairs near the threshold share a band."""
    choices = random.Random(length)
    met = seen = 0
    while seen < 300:
        a = "".join(choices.choices("abcdefghij ", k=length))
        cut = choices.randrange(1, max(2, length // 9))
        b = a[:-cut] + "".join(choices.choices("xyz", k=choices.randrange(cut + 1)))
        x, y = shingles(a), shingles(b)
        if not 0.8 <= len(x & y) / len(x | y) <= 0.9:
            continue
        seen += 1
        bands = band_hashes([a, b])
        met += bool((bands[0] == bands[1]).any())
    assert met >= 0.97 * seen


def edited(choices, line, edit):
    """``line`` with one character, or one word of six letters, replaced in its inside."""
    letter = lambda: choices.choice("uvwxyz")
    if edit == "character":
        at = choices.randrange(8, len(line) - 8)
        return line[:at] + letter() + line[at + 1 :]
    at = choices.randrange(2, len(line) // 7 - 2) * 7
    return line[:at] + "".join(letter() for _ in range(6)) + line[at + 6 :]


# One character is found from 40 characters on, one word of six letters from 84 on.
EDITS = [("character", n) for n in (40, 60, 90, 160)] + [("word", n) for n in (90, 120, 160)]


@pytest.mark.parametrize("edit, length", EDITS)
def test_edits_inside_a_line_are_found(edit, length):
    choices = random.Random(length)
    found = 0
    for _ in range(200):
        words = ["".join(choices.choices("abcdefghijklmnopqrst", k=6)) for _ in range(length // 7 + 1)]
        a = " ".join(words)[:length]
        b = edited(choices, a, edit)
        bands = band_hashes([a, b])
        near = Shingled([a, b], 0.8).near(0, np.array([1]))[0]
        found += bool(near and (bands[0] == bands[1]).any())
    assert found >= 0.97 * 200


def test_sketches_differ_in_no_more_bits_than_lines_in_shingles():
    choices = random.Random(3)
    lines = ["", "abc", "aaaaaaa"]
    for n in [*range(4, 60), 300, 900] * 3:
        line = "".join(choices.choices("abcd ", k=n))
        lines += [line, line[: n // 2] + "x" + line[n // 2 + 1 :]]
    sizes, bits = sketches(lines)
    sets = [shingles(x) for x in lines]
    assert sizes.tolist() == [len(x) for x in sets]
    for i, j in zip(range(len(lines)), range(1, len(lines)), strict=False):
        differ = sum((int(x) & (1 << 64) - 1).bit_count() for x in bits[i] ^ bits[j])
        assert differ <= len(sets[i] ^ sets[j])


def test_rows_near_another_component_are_all_kept():
    """Buckets of all sizes against plain loops over sets; no sketch may rule out a near line."""
    choices = random.Random(5)
    rows, near = [], set()
    for band in range(60):
        base = "".join(choices.choices("abcdefgh ", k=choices.randrange(60, 700)))
        lines = [base]
        for _ in range(choices.choice([1, 2, 5, 40])):
            line = list(base)
            for _ in range(choices.randrange(1, 12)):
                line[choices.randrange(len(line))] = choices.choice("xyz")
            lines.append("".join(line))
        sizes, bits = sketches(lines)
        sets = [shingles(x) for x in lines]
        for i in range(len(lines)):
            rows.append((band, len(rows), i % 3, 0, 0, int(sizes[i]), *bits[i].tolist()))
            if any(
                i % 3 != j % 3 and len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])
                for j in range(len(lines))
            ):
                near.add(rows[-1][1])
    names = ["band", "line", "component", "_one", "_two", "size"]
    table = pd.DataFrame(rows, columns=names + [f"bits{i}" for i in range(bits.shape[1])])
    kept = set(_maybe_joined(0.8)(table.sample(frac=1, random_state=1))["line"])
    assert near and near <= kept


def test_short_lines_with_a_typo_are_removed(spark):
    line = "the quick brown fox jumps over a lazy dog"
    rows = [(1, line), (2, line.replace("brown", "brawn"))]
    assert measured(docs(spark, rows)) == [(1, line), (2, "")]


def test_shingles_and_bands_of_odd_lines():
    lines = ["", "a", "漢字𝒳", "x" * 5000, "abcdefgh", "abcdefghi"]
    assert shingle_ids(lines)[1].tolist() == [1, 1, 1, 1, 1, 2]
    bands = band_hashes(lines)
    assert bands.shape[0] == len(lines) and len(np.unique(bands, axis=0)) == len(lines)
    assert (band_hashes(lines[::-1])[::-1] == bands).all()


@pytest.mark.parametrize("rows", [1, 2, 3, 7, 100])
def test_buckets_across_batches(spark, rows):
    """Buckets that begin, end or go on at the edges of batches."""
    choices = random.Random(rows)
    table = [(choices.randrange(30), choices.randrange(6)) for _ in range(120)]
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", rows)
    try:
        banded = spark.createDataFrame(table, "band bigint, line bigint").coalesce(1)
        found = _met(banded.sortWithinPartitions("band")).collect()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    buckets = {}
    for band, line in table:
        buckets.setdefault(band, set()).add(line)
    wanted = {(b, x) for b, m in buckets.items() if len(m) > 1 for x in m}
    assert {(r.band, r.line) for r in found} == wanted
    pivots = {(r.band, r.pivot) for r in found}
    assert len(pivots) == len({b for b, _ in wanted}) and pivots <= wanted


@pytest.mark.parametrize("bands_at_once", [1, 5, 1 << 20])
def test_lines_meet_in_buckets_as_row_by_row(spark, monkeypatch, bands_at_once):
    """Rows of a bucket and a stretch, many to a task; a bucket may come in parts."""
    from anchorctx.llm import line_dedup

    monkeypatch.setattr(line_dedup, "BANDS_AT_ONCE", bands_at_once)
    monkeypatch.setattr(line_dedup, "TEXT_AT_ONCE", 100)
    monkeypatch.setattr(line_dedup, "BUCKET_BITS", 3)
    monkeypatch.setattr(line_dedup, "REMEMBERED", 4)
    choices = random.Random(7)
    lines = [LINE % choices.choice(["one", "two", "three"]) + "!" * choices.randrange(3) for _ in range(40)]
    rows = [(i, "\n".join(choices.choices(lines, k=3))) for i in range(30)]
    banded = line_dedup._banded(docs(spark, rows).coalesce(2), "text")
    buckets = {}
    for r in banded.collect():
        bands, keys_ = (np.frombuffer(x, np.int64) for x in (r.bands, r.lines))
        assert (bands.view(np.uint64) >> np.uint64(61) == r.bucket).all()
        for b, x in zip(bands.tolist(), keys_.tolist(), strict=True):
            buckets.setdefault(b, set()).add(x)
    assert len({x for m in buckets.values() for x in m}) == len({x for _, t in rows for x in t.split("\n")})
    found = line_dedup._met_in_buckets(banded.repartition("bucket").sortWithinPartitions("bucket")).collect()
    wanted = {(b, x) for b, m in buckets.items() if len(m) > 1 for x in m}
    assert wanted and {(r.band, r.line) for r in found} == wanted
    pivots = {(r.band, r.pivot) for r in found}
    assert len(pivots) == len({b for b, _ in wanted}) and pivots <= wanted
    assert sum(r.line == r.pivot for r in found) == len(pivots)


def test_bands_travel_in_few_rows(spark):
    """Not one row per band and line, whatever the number of lines."""
    from anchorctx.llm import line_dedup

    rows = [(i, "\n".join(f"line {j} of text {i}" for j in range(100))) for i in range(200)]
    banded = line_dedup._banded(docs(spark, rows).coalesce(1), "text")
    found = banded.selectExpr("count(*)", "sum(length(lines)) div 8").first()
    assert found[1] == 200 * 100 * line_dedup.BANDS and found[0] * 10 < found[1]
