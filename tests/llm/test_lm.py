import math
import re
from collections import Counter
from types import SimpleNamespace
from zlib import crc32

import numpy as np
import xxhash
from tables import AWKWARD, SF_DIR, docs, given

import __spark_entry__ as entry
from anchorctx.llm import lm


def tokens(text):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return [*re.findall(r"[^\x20\x09-\x0D]+", lowered), None]


def held(doc_id):
    return doc_id is not None and crc32(str(doc_id).encode()) % 5 == 1


def expected(rows):
    counts = Counter()
    for d, t in rows:
        if not held(d):
            counts.update(tokens(t))
    n, v = sum(counts.values()), len(counts)
    out = []
    for d, t in rows:
        words = tokens(t)
        base = sum(math.log10((counts[w] + 0.5) / (n + 0.5 * (v + 1))) for w in words)
        known = sum(counts[w] > 0 for w in words)
        out.append((d, held(d), len(words), known, n, round(base, 6)))
    return sorted(out, key=str)


def rounded(rows):
    return sorted((tuple(r)[:5] + (round(r[5], 6),) for r in rows), key=str)


def test_awkward_rows(spark):
    rows = lm.score_documents(docs(spark, AWKWARD)).collect()
    assert rounded(rows) == expected(AWKWARD)
    assert all(math.isfinite(r.score) and r.score <= 0 for r in rows)


def test_empty_table_and_no_training_texts(spark):
    assert lm.score_documents(docs(spark, [])).collect() == []
    ids = [i for i in range(60) if held(i)][:3]
    rows = [(i, "some words") for i in ids]
    found = lm.score_documents(docs(spark, rows)).collect()
    assert {r.train_tokens for r in found} == {0}
    assert all(math.isfinite(r.score) and math.isfinite(r.base_score) for r in found)


def test_query_beats_the_counts_on_held_out_texts(spark):
    found = entry.queries()["op9_lm_scores"](spark, str(SF_DIR)).collect()
    table = [(r.doc_id, r.text) for r in given(spark).collect()]
    assert rounded(found) == expected(table)
    out = [r for r in found if r.held_out]
    assert sum(r.score for r in out) > sum(r.base_score for r in out)


def test_chunks_do_not_change_the_counts(spark, monkeypatch):
    monkeypatch.setattr(lm, "CHUNK_BYTES", 3000)
    table = given(spark)
    rows = [(r.doc_id, r.text) for r in table.collect()]
    assert rounded(lm.score_documents(table.coalesce(1)).collect()) == expected(rows)


def model(rows=lm.TABLE_ROWS):
    classes = lm.Classes({lm.END: 0, b"the": 1}, {b"abc": 1 + lm.TOP_WORDS})
    counts = np.random.default_rng(5).integers(0, 9, lm.LEAVES).astype(float)
    weights = np.random.default_rng(1).normal(size=(rows, lm.WIDTH)).astype(np.float32)
    return lm.Model(classes, int(counts.sum()), 500, counts, np.minimum(counts, 3), weights)


def log_probabilities(m, features, leaves):
    return lm.log_probabilities(m.weights, m.bias, features, leaves, m.classes.single)


def test_probabilities_of_all_buckets_add_up_to_one():
    m = model()
    features = np.random.default_rng(2).integers(0, 2**63, size=(lm.FEATURES, 3), dtype=np.uint64)
    # Classes of one word have one outcome, the others WIDTH.
    first = m.classes.single * lm.WIDTH
    leaves = np.append(np.arange(0, first, lm.WIDTH), np.arange(first, lm.LEAVES))
    for f in features.T:
        found = log_probabilities(m, np.repeat(f[:, None], len(leaves), axis=1), leaves)
        assert math.isclose(np.exp(found).sum(), 1, rel_tol=1e-4)


def test_words_of_a_bucket_add_up_to_one():
    """Known words and one unit for new ones."""
    m = model()
    leaf = (1 + lm.TOP_WORDS) * lm.WIDTH + 7
    m.leaf_counts[leaf], m.leaf_words[leaf] = 17, 3
    counts = np.array([10, 5, 2, 0])
    assert math.isclose((10 ** m.in_leaf(counts, np.full(4, leaf))).sum(), 1)


def mixed(x, times):
    return x * times % 2**64


def one_row(feature, line, size):
    """The row of a feature, by Python's numbers."""
    found = mixed((feature + mixed(line, 0xD6E8FEB86659FD93)) % 2**64, 0xBF58476D1CE4E5B9)
    return (found >> 40) % size


def one_feature(f, key):
    found = mixed((key + f + 1) % 2**64, 0x9E3779B97F4A7C15)
    return found ^ (found >> 31)


def score_by_loops(m, words, counts):
    """log10 probability of a text of words, token by token and outcome by outcome."""
    w, total = lm.WIDTH, 0.0
    hashes = [xxhash.xxh64_intdigest(x) for x in words]
    leaves = m.classes.leaves(words)
    classes = [int(x) // w for x in leaves]
    shares = m.leaf_counts.reshape(w, w, w)
    for i, word in enumerate(words):
        h = [hashes[i - b] if i >= b else 0 for b in (1, 2)]
        c = [classes[i - b] if i >= b else lm.CLASSES for b in (1, 2, 3)]
        keys = [*h, c[0] * (lm.CLASSES + 1) + c[1], c[0] * (lm.CLASSES + 1) + c[2]]
        features = [one_feature(f, key) for f, key in enumerate(keys)]
        group, inside, bucket = classes[i] // w, classes[i] % w, int(leaves[i]) % w
        steps = [
            (0, group, shares.sum(axis=(1, 2))),
            (1 + group, inside, shares[group].sum(axis=1)),
            (1 + w + classes[i], bucket, shares[group, inside]),
        ]
        for line, chosen, seen in steps[: 2 if classes[i] < m.classes.single else 3]:
            rows = [one_row(f, line, len(m.weights)) for f in features]
            powers = [
                math.log((seen[o] + 0.5) / (seen.sum() + 0.5 * w)) + sum(float(m.weights[r, o]) for r in rows)
                for o in range(w)
            ]
            total += math.log10(math.exp(powers[chosen]) / sum(map(math.exp, powers)))
        if classes[i] >= m.classes.single:
            leaf = int(leaves[i])
            total += math.log10(
                (counts[word] + 0.5) / (m.leaf_counts[leaf] + 0.5 * (m.leaf_words[leaf] + 1))
            )
    return total


def test_scores_of_given_texts_by_loops(spark, monkeypatch):
    """The query's scores from the trained weights, recomputed without arrays."""
    kept = []
    trained = lm._trained
    monkeypatch.setattr(lm, "_trained", lambda *args: kept.append(trained(*args)) or kept[0])
    table = given(spark).where("doc_id < 40")
    rows = table.select("doc_id", "text").collect()
    found = {r.doc_id: r for r in lm.score_documents(table).collect()}
    counts = Counter()
    for d, t in rows:
        if not held(d):
            counts.update((x or "").encode() for x in tokens(t))
    assert np.abs(kept[0].weights).max() > 0.1
    assert kept[0].total == sum(counts.values()) and kept[0].distinct == len(counts)
    for d, t in sorted(rows, key=lambda r: len(r.text or ""))[:12]:
        words = [(x or "").encode() for x in tokens(t)]
        wanted = score_by_loops(kept[0], words, counts)
        assert math.isclose(found[d].score, wanted, rel_tol=1e-4), d


def test_context_moves_probability_between_words_of_a_class():
    m = model()
    leaves = (1 + lm.TOP_WORDS) * lm.WIDTH + np.array([3, 4])
    one, two = (np.full((lm.FEATURES, 2), k, dtype=np.uint64) for k in (11, 12))
    difference = [np.subtract(*log_probabilities(m, f, leaves)) for f in (one, two)]
    assert abs(difference[0] - difference[1]) > 0.1


def test_features_look_back_within_the_text():
    hashes = np.array([5, 6, 7, 8, 5, 6], dtype=np.uint64)
    classes = np.array([1, 2, 3, 0, 1, 2])
    first = np.array([0, 0, 0, 0, 4, 4])
    rows = lm._features(hashes, classes, first)
    assert (rows[:, 0] == rows[:, 4]).all() and (rows[:, 1] == rows[:, 5]).all()
    assert (rows[:, 1] != rows[:, 2]).any()
    # A part of the tokens with the three before it has the same features.
    assert (lm._features(hashes[1:], classes[1:], first[1:] - 1)[:, 3:] == rows[:, 4:]).all()


def test_sums_of_rows():
    rows = np.array([3, 1, 3, 2, 1, 3, 9])
    values = np.arange(7 * lm.WIDTH, dtype=np.float32).reshape(7, lm.WIDTH)
    found, sums = lm._sums(rows, values)
    assert found.tolist() == [1, 2, 3, 9]
    for r, s in zip(found, sums, strict=True):
        assert (s == values[rows == r].sum(axis=0)).all()


def test_packing():
    numbers = np.array([0, 1, 255, 256, 70_000, 2**31])
    assert (lm._unpack(lm._pack(numbers)) == numbers).all()
    assert lm._unpack_words(lm._pack_words([b"", b"a", b"bc"])) == [b"", b"a", b"bc"]


def test_learning_raises_the_probability():
    m = model()
    m.weights[:] = 0
    rng = np.random.default_rng(3)
    tokens = rng.integers(0, 4, size=4000)
    # Every second word follows from the one before.
    tokens[1::2] = tokens[::2] ^ 1
    vocab = lm._pack_words([b"the", b"abcd", b"abcx", b"zz"])
    row = SimpleNamespace(sizes=[4000], tokens=lm._pack(tokens), vocab=vocab)
    coded = lm.Coded(row, m.classes)

    def total():
        return sum(log_probabilities(m, features, leaves).sum() for _, features, leaves in coded.parts())

    before = total()
    squares = np.zeros(lm.TABLE_ROWS, dtype=np.float32)
    for _ in range(20):
        seen = lm._learn(coded, np.array([True]), m.weights, squares, m.bias, m.classes.single)
        assert seen == 4000
    assert total() > before + 1000


def test_held_out_texts_gain_from_the_words_before(spark):
    """log10 per token; counts alone have -4.13, a trained class with counts inside it -3.89."""
    table = spark.read.parquet(str(SF_DIR.parent / "sf0.01" / "documents.parquet"))
    score, base, n = (
        lm.score_documents(table).where("held_out")
        .agg({"score": "sum", "base_score": "sum", "n_tokens": "sum"})
        .select("sum(score)", "sum(base_score)", "sum(n_tokens)").first()
    )
    assert base / n < -4.1 and score / n > -3.85


def test_the_word_two_back_is_a_feature():
    """Texts that differ in that word alone, not in classes."""
    classes = np.array([5, 5, 5, 0])
    first = np.zeros(4, dtype=np.int64)
    one, two = (
        lm._features(np.array([9, w, 7, 1], dtype=np.uint64), classes, first)[:, 3] for w in (20, 21)
    )
    assert (one != two).sum() == 1


def test_the_table_grows_with_the_features():
    assert lm.table_rows(0, 0) == lm.TABLE_ROWS
    assert lm.table_rows(10_000, 4_000) == 1 << 15
    assert lm.table_rows(10**6, 10**6) == lm.MOST_ROWS


def test_words_of_all_chunks_meet_their_totals_once(spark, monkeypatch):
    """The chunks' words pass one exchange by word; each word itself is kept once."""
    monkeypatch.setattr(lm, "CHUNK_BYTES", 40)
    rows = [(i, f"the word{i % 5} of the\ttext{i % 3} {'x' * (i % 4)}") for i in range(40)]
    chunks = lm.saved(lm._chunks(docs(spark, rows).coalesce(2), "doc_id", "text", 5, 1), "lm-chunks")
    found = lm._told(chunks)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("hashpartitioning(word") == 1
    counts, wanted, kept = Counter(), Counter(), Counter()
    for d, t in rows:
        if not held(d):
            counts.update((x or "").encode() for x in tokens(t))
    vocab = {r.chunk: lm._unpack_words(bytes(r.vocab)) for r in chunks.collect()}
    for words in vocab.values():
        wanted.update((w, counts[w]) for w in words if counts[w])
    told = found.collect()
    assert Counter((vocab[r.chunk][r.place], r.total) for r in told) == wanted
    for r in told:
        if r.word is not None:
            assert bytes(r.word) == vocab[r.chunk][r.place]
            kept[bytes(r.word)] += 1
    assert kept == Counter(list(counts))


def test_query_makes_the_words_of_the_chunks_once(spark, monkeypatch):
    calls, words = [], lm._words
    monkeypatch.setattr(lm, "_words", lambda chunks: calls.append(1) or words(chunks))
    lm.score_documents(docs(spark, AWKWARD)).collect()
    assert len(calls) == 1


def test_sums_of_rows_beyond_32_bits():
    rows = np.array([2**40, 5, 2**40 + 1, 2**40])
    values = np.arange(4 * lm.WIDTH, dtype=np.float32).reshape(4, lm.WIDTH)
    found, sums = lm._sums(rows, values)
    assert found.tolist() == [5, 2**40, 2**40 + 1]
    assert (sums[1] == values[0] + values[3]).all()


def test_changes_take_less_than_by_deflate():
    """Signs and exponents are apart from the digits that nothing can compress."""
    import zlib

    change = np.random.default_rng(4).normal(scale=0.2, size=(lm.SLAB_ROWS, lm.WIDTH)).astype(np.float32)
    packed = lm._pack_change(change)
    assert (lm._unpack_change(packed) == change.astype(np.float16)).all()
    assert len(packed) < 0.95 * len(zlib.compress(change.astype(np.float16).tobytes(), 1))
