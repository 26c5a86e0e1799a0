import itertools
import random
import re

import numpy as np
import xxhash
from tables import AWKWARD, docs, given

from anchorctx.llm.simhash import (
    BITS,
    covering_masks,
    fingerprint,
    linked_fingerprints,
    one_of_each_group,
    simhash_groups,
)


def slow_fingerprint(text, n=4):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    if not words:
        return 0
    shingles = [" ".join(words[i : i + n]) for i in range(max(1, len(words) - n + 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(values, bits):
    root = {v: v for v in values}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in itertools.combinations(sorted(values), 2):
        if (a ^ b).bit_count() <= bits:
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    return {v: find(v) for v in values}


def expected(rows):
    fps = [slow_fingerprint(t) for _, t in rows]
    part = components(set(fps), 4)
    least = {}
    for (d, _), f in zip(rows, fps, strict=True):
        if d is not None:
            least[part[f]] = min(least.get(part[f], d), d)
    return sorted(
        ((d, f"{f:016x}", least.get(part[f])) for (d, _), f in zip(rows, fps, strict=True)), key=str
    )


def measured(table):
    found = simhash_groups(table).select("doc_id", "fingerprint", "component_id")
    return sorted((tuple(r) for r in found.collect()), key=str)


def test_given_documents(spark):
    table = given(spark)
    assert measured(table) == expected([(r.doc_id, r.text) for r in table.collect()])


def test_awkward_rows_and_one_of_each_group(spark):
    rows = [*AWKWARD, (None, None), (None, "nobody knows the id of this one")]
    table = docs(spark, rows)
    groups = expected(rows)
    assert measured(table) == groups
    left = one_of_each_group(table)
    assert left.columns == table.columns
    parts = components({slow_fingerprint(t) for _, t in rows}, 4)
    assert left.count() == len(set(parts.values()))
    kept = {r.doc_id for r in left.collect()}
    assert kept - {None} <= {g[2] for g in groups}


def test_empty_table(spark):
    assert measured(docs(spark, [])) == []
    assert one_of_each_group(docs(spark, [])).count() == 0


def test_masks_cover_every_pair_within_the_radius():
    masks = np.array(covering_masks(4), dtype=np.uint64)
    assert len(masks) == 31
    choices = random.Random(1)
    for _ in range(20_000):
        difference = sum(1 << b for b in choices.sample(range(BITS), 4))
        assert (masks & np.uint64(difference) == 0).any()
    small = np.array(covering_masks(2), dtype=np.uint64)
    for a, b in itertools.combinations(range(BITS), 2):
        assert (small & np.uint64(1 << a | 1 << b) == 0).any()


def test_a_hot_bucket_is_linked_without_its_pairs(spark):
    """Many fingerprints near a few centres, in blocks far smaller than the buckets."""
    choices = random.Random(3)
    values = set()
    for centre in [choices.getrandbits(64) for _ in range(3)] + [0]:
        for _ in range(150):
            values.add(centre ^ sum(1 << b for b in choices.sample(range(64), choices.choice([1, 2, 3, 5, 6]))))
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    table = spark.createDataFrame([(v,) for v in signed], "fp bigint")
    found = {
        r.node & (1 << 64) - 1: r.component for r in linked_fingerprints(table, 4, block=16).collect()
    }
    parts = components(values, 4)
    wanted, got = {}, {}
    for v in values:
        wanted.setdefault(parts[v], set()).add(v)
        got.setdefault(found.get(v, ("alone", v)), set()).add(v)
    assert sorted(map(sorted, wanted.values())) == sorted(map(sorted, got.values()))


def test_long_texts_count_in_parts(monkeypatch):
    import anchorctx.llm.simhash as module

    text = " ".join(f"w{i % 700}" for i in range(3000))
    whole = fingerprint(text.encode(), 4)
    monkeypatch.setattr(module, "SHINGLES_AT_ONCE", 64)
    assert fingerprint(text.encode(), 4) == whole == slow_fingerprint(text)
