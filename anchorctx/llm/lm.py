"""Hashed maximum-entropy language model with class-factored softmax."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from anchorctx.llm.common import documents, held_out, saved, shuffles_removed

# Text of one chunk, the unit that is numbered, learned from and scored.
CHUNK_BYTES = 2 << 20
# Tokens whose probabilities are worked out at a time.
TOKENS_AT_ONCE = 1 << 13
# Of these, tokens whose outcomes are worked out at a time, so that arrays stay in the cache.
OUTCOMES_AT_ONCE = 1 << 11
# The end of a text as a word; no word is empty.
END = b""
# Outcomes of each of the three softmaxes: groups, classes of a group, buckets of a class.
WIDTH = 32
CLASSES = WIDTH * WIDTH
LEAVES = CLASSES * WIDTH
TOP_WORDS, TOP_PREFIXES, OTHER_CLASSES = CLASSES // 4 - 1, CLASSES // 2, CLASSES // 4
PREFIX = 3
FEATURES = 4
# Rows of the weight table: as many as distinct features, between these two.
TABLE_ROWS, MOST_ROWS = 1 << 13, 1 << 18
SLAB_ROWS = 1 << 12
ROUNDS = 3
RATE, DAMPING = 0.3, 0.1
# Tasks whose changes are added up first, so that no task gets those of all.
TASKS_ADDED = 128

CHUNK_SCHEMA = (
    "chunk bigint, doc_ids array<bigint>, no_id array<boolean>, held array<boolean>,"
    " sizes array<int>, tokens binary, vocab binary, counts binary"
)


def _squeezed(data: bytes, level: int = 3) -> bytes:
    return len(data).to_bytes(8, "little") + pa.Codec("zstd", level).compress(data, asbytes=True)


def _unsqueezed(data: bytes) -> bytes:
    return pa.decompress(data[8:], int.from_bytes(data[:8], "little"), codec="zstd", asbytes=True)


def _pack(numbers: np.ndarray) -> bytes:
    """Byte planes, compressed; small numbers leave the high planes empty."""
    return _squeezed(numbers.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes())


def _unpack(data: bytes) -> np.ndarray:
    planes = np.frombuffer(_unsqueezed(data), dtype=np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<u4").reshape(-1).astype(np.int64)


def _pack_words(words: list[bytes]) -> bytes:
    return _squeezed(b"\n".join(words))


def _unpack_words(data: bytes) -> list[bytes]:
    return _unsqueezed(data).split(b"\n")


def _chunk(number: int, docs: list[tuple]) -> pa.RecordBatch:
    """Numbers the words of some documents; ``docs`` holds (doc_id, held, body)."""
    numbers: defaultdict[bytes, int] = defaultdict()
    numbers.default_factory = numbers.__len__  # a new word gets the next number
    texts = []
    for _, _, body in docs:
        words = body.lower().split()
        words.append(END)
        texts.append(np.fromiter(map(numbers.__getitem__, words), np.int64, len(words)))
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    tokens = np.concatenate(texts)
    learned = np.repeat(np.array([not held for _, held, _ in docs]), sizes)
    by_use = np.argsort(-np.bincount(tokens, minlength=len(numbers)), kind="stable")
    place = np.empty(len(numbers), dtype=np.int64)
    place[by_use] = np.arange(len(numbers))
    tokens = place[tokens]
    words = list(numbers)
    row = {
        "chunk": [number],
        "doc_ids": [[d or 0 for d, _, _ in docs]],
        "no_id": [[d is None for d, _, _ in docs]],
        "held": [[h for _, h, _ in docs]],
        "sizes": [sizes],
        "tokens": [_pack(tokens)],
        "vocab": [_pack_words([words[i] for i in by_use.tolist()])],
        "counts": [_pack(np.bincount(tokens[learned], minlength=len(words)))],
    }
    types = [pa.int64(), pa.list_(pa.int64()), pa.list_(pa.bool_()), pa.list_(pa.bool_()),
             pa.list_(pa.int32()), pa.binary(), pa.binary(), pa.binary()]
    arrays = [pa.array(v, t) for v, t in zip(row.values(), types, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, list(row))


def _chunks(docs: DataFrame, doc_id: str, text: str, mod: int, remainder: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        docs, size = [], 0
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                docs.append(row)
                size += len(row[2])
                if size >= CHUNK_BYTES:
                    yield _chunk(number, docs)
                    number, docs, size = number + 1, [], 0
        if docs:
            yield _chunk(number, docs)

    return docs.select(
        F.col(doc_id).cast("bigint"),
        held_out(doc_id, mod, remainder).alias("held"),
        F.coalesce(F.col(text), F.lit("")).cast("binary").alias("body"),
    ).mapInArrow(run, CHUNK_SCHEMA)


@dataclass
class Classes:
    """A word's class: the end, a frequent word, a frequent beginning, or a hash of the beginning.

    Classes of neighbouring numbers are a group; a bucket is a hash of the word.
    """

    words: dict[bytes, int]
    prefixes: dict[bytes, int]

    @property
    def single(self) -> int:
        """Classes below have one word, thus no buckets."""
        return len(self.words)

    def leaves(self, vocab: list[bytes]) -> np.ndarray:
        """class * WIDTH + bucket of each word."""
        digest, n = xxhash.xxh32_intdigest, len(vocab)
        beginnings = [w[:PREFIX] for w in vocab]
        # Many words have one beginning.
        classes = {
            b: self.prefixes[b] if b in self.prefixes else CLASSES - 1 - digest(b) % OTHER_CLASSES
            for b in set(beginnings)
        }
        found = np.fromiter(map(classes.__getitem__, beginnings), np.int64, n) * WIDTH
        found += np.fromiter(map(digest, vocab), np.int64, n) % WIDTH
        frequent = np.fromiter(map(self.words.get, vocab, repeat(-1)), np.int64, n)
        return np.where(frequent < 0, found, frequent * WIDTH)


@dataclass
class Model:
    classes: Classes
    total: int  # training tokens
    distinct: int  # distinct training tokens
    leaf_counts: np.ndarray  # training tokens of each bucket
    leaf_words: np.ndarray  # distinct training words of each bucket
    weights: np.ndarray  # table_rows() x WIDTH

    @property
    def bias(self) -> np.ndarray:
        """Logarithms of shares by counts: a line for the groups, one per group, one per class."""
        classes = self.leaf_counts.reshape(-1, WIDTH)
        groups = classes.sum(axis=1).reshape(-1, WIDTH)
        counts = np.concatenate([groups.sum(axis=1)[None], groups, classes]) + 0.5
        return np.log(counts / counts.sum(axis=1, keepdims=True)).astype(np.float32)

    def in_leaf(self, counts: np.ndarray, leaves: np.ndarray) -> np.ndarray:
        """log10 of a word's share of its bucket; one unit of each bucket is kept for new words."""
        share = np.log10(
            (counts + 0.5) / (self.leaf_counts[leaves] + 0.5 * (self.leaf_words[leaves] + 1))
        )
        return np.where(leaves < self.classes.single * WIDTH, 0.0, share)


def table_rows(total: int, distinct: int) -> int:
    """Rows for the features that so many tokens, so many of them distinct, can have."""
    features = 2 * distinct + 2 * min(total, (CLASSES + 1) ** 2)
    return min(max(TABLE_ROWS, 1 << (features - 1).bit_length()), MOST_ROWS)


def _features(hashes: np.ndarray, classes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Hashed features of each token: the words one and two before, the classes one and
    two before, and the classes one and three before. Texts begin with no words before."""
    n = len(hashes)
    back_words, back_classes = [], []
    for back in (1, 2, 3):
        w = np.zeros(n, dtype=np.uint64)
        c = np.full(n, CLASSES, dtype=np.uint64)
        w[back:], c[back:] = hashes[:-back], classes[:-back]
        outside = np.arange(n) - back < first
        w[outside], c[outside] = 0, CLASSES
        back_words.append(w)
        back_classes.append(c)
    pairs = [(back_classes[0], back_classes[1]), (back_classes[0], back_classes[2])]
    keys = back_words[:2] + [a * np.uint64(CLASSES + 1) + b for a, b in pairs]
    found = np.empty((FEATURES, n), dtype=np.uint64)
    for f, key in enumerate(keys):
        mixed = (key + np.uint64(f + 1)) * np.uint64(0x9E3779B97F4A7C15)
        found[f] = mixed ^ (mixed >> np.uint64(31))
    return found


def _rows(features: np.ndarray, lines: np.ndarray, size: int) -> np.ndarray:
    """Rows of the weight table for features of a softmax, which its line of the bias names."""
    mixed = features + lines.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
    mixed *= np.uint64(0xBF58476D1CE4E5B9)
    return (mixed >> np.uint64(40)).astype(np.int64) & (size - 1)


def _levels(features: np.ndarray, leaves: np.ndarray, single: int, size: int):
    """For each of the three softmaxes its tokens, rows, lines of the bias and outcomes.

    A token whose class has one word takes no part in the last.
    """
    everything = np.arange(len(leaves))
    classes = leaves // WIDTH
    groups = classes // WIDTH
    lines = np.zeros(len(leaves), dtype=np.int64)
    yield everything, _rows(features, lines, size), lines, groups
    yield everything, _rows(features, 1 + groups, size), 1 + groups, classes % WIDTH
    some = np.flatnonzero(classes >= single)
    lines = 1 + WIDTH + classes[some]
    yield some, _rows(features[:, some], lines, size), lines, leaves[some] % WIDTH


class Coded:
    """A chunk row as arrays over its tokens."""

    def __init__(self, row, classes: Classes):
        self.sizes = np.asarray(row.sizes, dtype=np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.tokens = _unpack(row.tokens)
        vocab = _unpack_words(row.vocab)
        self.word_hashes = np.fromiter(map(xxhash.xxh64_intdigest, vocab), np.uint64, len(vocab))
        self.word_leaves = classes.leaves(vocab)

    def parts(self, texts: np.ndarray | None = None):
        """Features and leaves of TOKENS_AT_ONCE tokens at a time, of the given texts or all."""
        first = np.repeat(self.starts.astype(np.int32), self.sizes)
        wanted = None if texts is None else np.repeat(texts, self.sizes)
        for at in range(0, len(self.tokens), TOKENS_AT_ONCE):
            # Three more tokens before, for the features that look back.
            low, high = max(0, at - 3), min(len(self.tokens), at + TOKENS_AT_ONCE)
            tokens = self.tokens[low:high]
            leaves = self.word_leaves[tokens]
            features = _features(self.word_hashes[tokens], leaves // WIDTH, first[low:high] - low)
            features, leaves = features[:, at - low :], leaves[at - low :]
            if wanted is None:
                yield at, features, leaves
            elif (use := wanted[at:high]).any():
                yield at, features[:, use], leaves[use]


def _scores(weights: np.ndarray, bias: np.ndarray, rows: np.ndarray, lines: np.ndarray):
    """The outcomes' exponents, one line per token, of OUTCOMES_AT_ONCE tokens at a time.

    The arrays are overwritten by the next ones.
    """
    kept, added = np.empty((2, min(len(lines), OUTCOMES_AT_ONCE), weights.shape[1]), dtype=np.float32)
    for at in range(0, len(lines), OUTCOMES_AT_ONCE):
        part = slice(at, min(at + OUTCOMES_AT_ONCE, len(lines)))
        n = part.stop - at
        # Rows are never outside; another mode than "clip" would copy once more.
        scores = bias.take(lines[part], axis=0, out=kept[:n], mode="clip")
        for r in rows[:, part]:
            scores += weights.take(r, axis=0, out=added[:n], mode="clip")
        # Far beyond what weights reach; keeps the exponentials finite without a pass for the maximum.
        yield part, np.clip(scores, -60, 60, out=scores)


def log_probabilities(
    weights: np.ndarray, bias: np.ndarray, features: np.ndarray, leaves: np.ndarray, single: int
) -> np.ndarray:
    """Natural logarithms of the probabilities of one bucket, or class of one word, for each token."""
    found, ones = np.zeros(len(leaves)), np.ones(weights.shape[1], dtype=np.float32)
    for some, rows, lines, chosen in _levels(features, leaves, single, len(weights)):
        for part, scores in _scores(weights, bias, rows, lines):
            found[some[part]] += scores[np.arange(len(scores)), chosen[part]]
            found[some[part]] -= np.log(np.exp(scores, out=scores) @ ones)
    return found


def _sums(rows: np.ndarray, values: np.ndarray, out: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """The distinct ``rows`` and the sums of their lines of ``values``, in ``out`` if there is one."""
    order = np.argsort(rows)
    rows = rows[order]
    starts = np.flatnonzero(np.append(True, rows[1:] != rows[:-1]))
    sums = values.take(order[starts], axis=0, out=None if out is None else out[: len(starts)], mode="clip")
    # Most rows have one line; only the others are added up.
    sizes = np.diff(np.append(starts, len(rows)))
    several = sizes > 1
    if several.any():
        lines = values.take(order[np.repeat(several, sizes)], axis=0)
        sizes = sizes[several]
        sums[several] = np.add.reduceat(lines, np.cumsum(sizes) - sizes, axis=0)
    return rows[starts], sums


def _learn(coded: Coded, learned: np.ndarray, weights, squares, bias, single: int) -> int:
    """Steps of gradient ascent over a chunk's training texts; returns the tokens seen."""
    seen, ones = 0, np.ones(WIDTH, dtype=np.float32)
    # A row of weights as one value, which is put back at once.
    whole = weights.view(np.dtype((np.void, weights.itemsize * WIDTH)))[:, 0]
    # Arrays for all steps.
    gradients, added, before = np.empty((3, TOKENS_AT_ONCE, WIDTH), dtype=np.float32)
    for _, features, leaves in coded.parts(learned):
        for some, rows, lines, chosen in _levels(features, leaves, single, len(weights)):
            if not len(some):
                continue
            gradient = gradients[: len(some)]
            for part, scores in _scores(weights, bias, rows, lines):
                np.exp(scores, out=scores)
                np.multiply(scores, (-1 / (scores @ ones))[:, None], out=gradient[part])
            gradient[np.arange(len(some)), chosen] += 1
            for r in rows:
                row, sums = _sums(r, gradient, added)
                found = squares.take(row) + np.einsum("ij,ij->i", sums, sums) / WIDTH
                squares[row] = found
                sums *= (RATE / np.sqrt(found + DAMPING))[:, None]
                sums += weights.take(row, axis=0, out=before[: len(row)], mode="clip")
                whole[row] = sums.view(whole.dtype)[:, 0]
        seen += len(leaves)
    return seen


def _pack_change(change: np.ndarray) -> bytes:
    """Byte planes: only the upper ones, of signs and exponents, can be compressed."""
    return _squeezed(change.astype("<f2").view(np.uint8).reshape(-1, 2).T.tobytes(), 1)


def _unpack_change(change: bytes) -> np.ndarray:
    planes = np.frombuffer(_unsqueezed(change), dtype=np.uint8).reshape(2, -1)
    return np.ascontiguousarray(planes.T).view("<f2").reshape(SLAB_ROWS, WIDTH)


def _trained(chunks: DataFrame, model: Model) -> Model:
    """Rounds of updates: tasks learn from their chunks, and their changes are averaged by tokens.

    Each training chunk is gone through once, in one of ROUNDS rounds. The driver gets the table
    of weights alone, whose size has a limit.
    """
    spark = chunks.sparkSession
    for round_ in range(ROUNDS):
        shared = spark.sparkContext.broadcast(model)

        def run(batches: Iterator[pd.DataFrame], shared=shared) -> Iterator[pd.DataFrame]:
            model = shared.value
            weights, bias = model.weights.copy(), model.bias
            squares = np.zeros(len(weights), dtype=np.float32)
            seen = 0
            for batch in batches:
                for row in batch.itertuples(index=False):
                    learned = ~np.asarray(row.held, dtype=bool)
                    if learned.any():
                        coded = Coded(row, model.classes)
                        seen += _learn(coded, learned, weights, squares, bias, model.classes.single)
            for at in range(0, len(weights) if seen else 0, SLAB_ROWS):
                change = weights[at : at + SLAB_ROWS] - model.weights[at : at + SLAB_ROWS]
                yield pd.DataFrame(
                    {
                        "slab": [at // SLAB_ROWS],
                        "tasks": TaskContext.get().partitionId() // TASKS_ADDED,
                        "seen": float(seen),
                        "change": [_pack_change(change)],
                    }
                )

        def averaged(rows: pd.DataFrame) -> pd.DataFrame:
            total = np.zeros((SLAB_ROWS, WIDTH), dtype=np.float32)
            share = rows["seen"] / rows["seen"].sum()
            for part, change in zip(share, rows["change"], strict=True):
                total += np.float32(part) * _unpack_change(change)
            found = rows.iloc[:1].copy()
            found["seen"] = rows["seen"].sum()
            found["change"] = [_pack_change(total)]
            return found

        schema = "slab int, tasks int, seen double, change binary"
        changes = (
            chunks.where(F.pmod(F.col("chunk"), F.lit(ROUNDS)) == round_)
            .select("held", "sizes", "tokens", "vocab")
            .mapInPandas(run, schema)
            .groupBy("slab", "tasks").applyInPandas(averaged, schema)
            .groupBy("slab").applyInPandas(averaged, schema)
        )
        found = changes.collect()
        shared.destroy()
        for slab, _, _, change in found:
            model.weights[slab * SLAB_ROWS : (slab + 1) * SLAB_ROWS] += _unpack_change(change)
    return model


def _scored(model: Model):
    def run(chunk: pd.DataFrame, told: pd.DataFrame) -> pd.DataFrame:
        m = model.value
        row = next(chunk.itertuples(index=False))
        coded = Coded(row, m.classes)
        counts = np.zeros(len(coded.word_leaves), dtype=np.int64)
        counts[told["place"].to_numpy()] = told["total"].to_numpy()
        base = np.log10((counts + 0.5) / (m.total + 0.5 * (m.distinct + 1)))
        score = m.in_leaf(counts, coded.word_leaves)[coded.tokens]
        bias = m.bias
        for at, features, leaves in coded.parts():
            found = log_probabilities(m.weights, bias, features, leaves, m.classes.single)
            score[at : at + len(leaves)] += found / np.log(10)
        return pd.DataFrame(
            {
                "doc_id": pd.arrays.IntegerArray(
                    np.asarray(row.doc_ids, dtype=np.int64), np.asarray(row.no_id, bool)
                ),
                "held_out": np.asarray(row.held, dtype=bool),
                "n_tokens": coded.sizes,
                "n_known": np.add.reduceat((counts > 0)[coded.tokens], coded.starts, dtype=np.int64),
                "train_tokens": m.total,
                "base_score": np.add.reduceat(base[coded.tokens], coded.starts),
                "score": np.add.reduceat(score, coded.starts),
            }
        )

    return run


def _words(chunks: DataFrame) -> DataFrame:
    """(chunk, place, word, uses): the words of each chunk with their uses in training texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk, vocab, counts in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                words = pa.array(_unpack_words(vocab), pa.binary())
                n = len(words)
                columns = [
                    pa.array(np.full(n, chunk, np.int64)),
                    pa.array(np.arange(n, dtype=np.int32)),
                    words,
                    pa.array(_unpack(counts)),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["chunk", "place", "word", "uses"])

    return chunks.select("chunk", "vocab", "counts").mapInArrow(
        run, "chunk bigint, place int, word binary, uses bigint"
    )


def _told(chunks: DataFrame) -> DataFrame:
    """(chunk, place, total, word): the words of each chunk with their uses in all training texts.

    Only the first chunk of a word has the word itself. Words without such uses are left out. A word
    has one row per chunk, so that the rows of the most common are no more than the chunks.
    """
    same = Window.partitionBy("word")
    return (
        _words(chunks)
        .select(
            "chunk", "place", "word",
            F.sum("uses").over(same).alias("total"), F.min("chunk").over(same).alias("first"),
        )
        .where("total > 0")
        .select("chunk", "place", "total", F.when(F.col("chunk") == F.col("first"), F.col("word")).alias("word"))
    )


def _classes(totals: DataFrame) -> Classes:
    frequent = totals.where(F.length("word") > 0).orderBy(F.desc("total"), "word").limit(TOP_WORDS)
    words = {END: 0}
    for (word,) in frequent.select("word").collect():
        words[bytes(word)] = len(words)
    prefixes = (
        totals.where(~F.col("word").isin([F.lit(w) for w in words]))
        .groupBy(F.substring("word", 1, PREFIX).alias("prefix")).agg(F.sum("total").alias("total"))
        .orderBy(F.desc("total"), "prefix").limit(TOP_PREFIXES)
    )
    found = [bytes(p) for (p,) in prefixes.select("prefix").collect()]
    return Classes(words, {p: 1 + TOP_WORDS + i for i, p in enumerate(found)})


def _model(totals: DataFrame) -> Model:
    """Counts of the corpus and its classes; weights of zero."""
    classes = _classes(totals)

    @F.pandas_udf("int")
    def leaf(words: pd.Series) -> pd.Series:
        return pd.Series(classes.leaves([bytes(w) for w in words]).astype(np.int32))

    counts, words = np.zeros(LEAVES), np.zeros(LEAVES)
    for at, total, distinct in (
        totals.groupBy(leaf("word")).agg(F.sum("total"), F.count("*")).toLocalIterator()
    ):
        counts[at], words[at] = total, distinct
    rows = table_rows(int(counts.sum()), int(words.sum()))
    weights = np.zeros((rows, WIDTH), dtype=np.float32)
    return Model(classes, int(counts.sum()), int(words.sum()), counts, words, weights)


def score_documents(
    docs: DataFrame, *, mod: int = 5, remainder: int = 1, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Per document the log10 probability of its text, under a trained model and by counts alone.

    Documents whose crc32(doc_id as text) mod ``mod`` is ``remainder`` are held out; the
    others, and those without an id, teach. Tokens are words between ASCII white space, A-Z in
    lower case, and one end. ``base_score`` adds up log10((c + 0.5) / (N + 0.5 * (V + 1))) with c
    the token's count, N all and V the distinct tokens of training texts. ``score`` adds up the
    model's log10 P(group | before) + log10 P(class | group, before) + log10 P(bucket | class,
    before) + log10 P(word | bucket).

    A class is the end, a frequent word, a frequent beginning of words or a hash of the beginning;
    WIDTH classes are a group, and the words of a class are dealt to WIDTH buckets by their hash.
    The first three factors are softmaxes of weights of the same hashed features (the words one and two
    before, and the pairs of classes one and two, and one and three before), so words before
    also shift probability between the words of a class. A bucket is one of LEAVES; only within it do
    words go by counts. Every training text is learned from: tasks go through their chunks in small
    steps from a common table of weights, whose changes are averaged. The table has a row for each
    distinct feature, up to MOST_ROWS, beyond which features share rows; so it may be collected and
    broadcast; words, counts and texts stay distributed.

    A null text is empty and has the end alone. Null ids, repeated rows and an empty table come out
    as they are. Without training texts N and V are 0. Other columns are not read. A chunk is as long
    as its longest text, if that is beyond CHUNK_BYTES.
    """
    chunks = saved(_chunks(docs, doc_id, text, mod, remainder), "lm-chunks")
    with shuffles_removed(docs.sparkSession):
        told = saved(_told(chunks), "lm-told")
        model = _trained(chunks, _model(told.where("word is not null").select("word", "total")))
    told = told.select("chunk", "place", "total")
    shared = docs.sparkSession.sparkContext.broadcast(model)
    return chunks.drop("counts").groupBy("chunk").cogroup(told.groupBy("chunk")).applyInPandas(
        _scored(shared),
        "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint,"
        " base_score double, score double",
    )


def op9_lm_scores(spark, sf_dir):
    return score_documents(documents(spark, sf_dir))
