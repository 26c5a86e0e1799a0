"""Byte-level BPE: merges found by a segment tree over byte positions."""

from __future__ import annotations

import base64
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from anchorctx.llm.common import documents, prepare

# Pieces whose ids a task remembers; beyond that it starts anew, so memory stays bounded.
REMEMBERED = 200_000
# Longer pieces are rarely met twice.
REMEMBERED_LENGTH = 64
# Characters of texts that are encoded together, bytes of pieces that share steps, and their number.
TEXT_AT_ONCE = 1 << 19
SHORT, PIECES_AT_ONCE = 64, 4096
NONE = 1 << 62


def read_ranks(path: str) -> dict[bytes, int]:
    """Rank file of lines ``base64(token) rank``."""
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


def merge(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The ids of one piece.

    A leaf of the tree stands for the pair of live tokens of which the first starts at its
    byte, and holds rank * n + position, so the root is the leftmost pair of the least rank. A
    merge takes out the second token and renews the leaves of the merged one and of its
    neighbour to the left, each along one path to the root.
    """
    n = len(piece)
    whole = ranks.get(piece)
    if whole is not None:
        return [whole]
    leaves = 1
    while leaves < n - 1:
        leaves *= 2
    tree = [NONE] * (2 * leaves)
    rank = ranks.get
    for i in range(n - 1):
        if (r := rank(piece[i : i + 2])) is not None:
            tree[leaves + i] = r * n + i
    for i in range(leaves - 1, 0, -1):
        a, b = tree[2 * i], tree[2 * i + 1]
        tree[i] = a if a < b else b
    after = list(range(1, n + 1))
    before = list(range(-1, n - 1))

    def put(i: int, value: int) -> None:
        i += leaves
        tree[i] = value
        while i > 1:
            other = tree[i ^ 1]
            if other < value:
                value = other
            i >>= 1
            if tree[i] == value:
                return
            tree[i] = value

    while (best := tree[1]) != NONE:
        i = best % n
        gone = after[i]
        end = after[gone]
        after[i] = end
        if gone < n - 1:
            put(gone, NONE)
        if end < n:
            before[end] = i
            r = rank(piece[i : after[end]])
            put(i, NONE if r is None else r * n + i)
        else:
            put(i, NONE)
        if (left := before[i]) >= 0:
            r = rank(piece[left:end])
            put(left, NONE if r is None else r * n + left)
    ids, i = [], 0
    while i < n:
        ids.append(ranks[piece[i : after[i]]])
        i = after[i]
    return ids


def pair_table(ranks: dict[bytes, int]) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of tokens that make a token, as left * n + right in order, and its rank."""
    n = max(ranks.values()) + 1
    found = {
        ranks[left] * n + ranks[right]: rank
        for token, rank in ranks.items()
        for left, right in ((token[:k], token[k:]) for k in range(1, len(token)))
        if left in ranks and right in ranks
    }
    keys = np.array(sorted(found), dtype=np.int64)
    return keys, np.array([found[k] for k in keys.tolist()], dtype=np.int64)


class Merger:
    """``merge`` for many short pieces at once: a row of arrays per piece, a step per merge."""

    def __init__(self, ranks: dict[bytes, int], pairs: tuple[np.ndarray, np.ndarray]):
        self.ranks = ranks
        self.count = max(ranks.values()) + 1
        self.keys, self.merged = pairs
        self.bytes = np.array([ranks[bytes([b])] for b in range(256)], dtype=np.int64)

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left * self.count + right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.merged[at], -1)

    def __call__(self, pieces: list[bytes]) -> list[list[int]]:
        """The ids of each piece."""
        found: list = [None] * len(pieces)
        by_size: dict[int, list[int]] = {}
        for p, piece in enumerate(pieces):
            whole = self.ranks.get(piece)
            if whole is not None:
                found[p] = [whole]
            elif len(piece) > SHORT:
                found[p] = merge(piece, self.ranks)
            else:
                by_size.setdefault(1 << (len(piece) - 1).bit_length(), []).append(p)
        for leaves, places in by_size.items():
            for at in range(0, len(places), PIECES_AT_ONCE):
                part = places[at : at + PIECES_AT_ONCE]
                ids, counts = self._merged([pieces[p] for p in part], leaves)
                ends = np.cumsum(counts).tolist()
                for p, start, end in zip(part, [0, *ends], ends, strict=False):
                    found[p] = ids[start:end]
        return found

    def _merged(self, pieces: list[bytes], leaves: int) -> tuple[list[int], np.ndarray]:
        """Ids, piece after piece, and how many each has; ``leaves`` is a power of 2."""
        count, width = len(pieces), leaves + 1
        sizes = np.fromiter(map(len, pieces), np.int64, count)
        raw = np.frombuffer(b"".join(p.ljust(width, b"\0") for p in pieces), np.uint8)
        token = self.bytes[raw.reshape(count, width)]
        place = np.arange(width)
        live = place < sizes[:, None]
        after = np.tile(place + 1, (count, 1))
        before = np.tile(place - 1, (count, 1))
        first = self.rank(token[:, :-1], token[:, 1:])
        valid = (first >= 0) & (place[:-1] < sizes[:, None] - 1)
        tree = np.full((count, 2 * leaves), NONE, dtype=np.int64)
        tree[:, leaves:] = np.where(valid, first * width + place[:-1], NONE)
        level = leaves
        while level > 1:
            np.minimum(tree[:, level : 2 * level : 2], tree[:, level + 1 : 2 * level : 2],
                       out=tree[:, level // 2 : level])
            level //= 2
        rows = np.arange(count)
        while True:
            best = tree[rows, 1]
            going = best != NONE
            rows, best = rows[going], best[going]
            if not len(rows):
                break
            new, i = np.divmod(best, width)
            gone = after[rows, i]
            end = after[rows, gone]
            token[rows, i], after[rows, i] = new, end
            live[rows, gone] = False
            more = end < sizes[rows]
            next_ = np.minimum(end, leaves)
            before[rows[more], end[more]] = i[more]
            rank = np.where(more, self.rank(new, token[rows, next_]), -1)
            left = before[rows, i]
            has = left >= 0
            left_rows, left = rows[has], left[has]
            left_rank = self.rank(token[left_rows, left], new[has])
            # The three renewed leaves, then their paths to the root, level by level.
            tree[rows, leaves + gone] = NONE
            tree[rows, leaves + i] = np.where(rank >= 0, rank * width + i, NONE)
            tree[left_rows, leaves + left] = np.where(
                left_rank >= 0, left_rank * width + left, NONE
            )
            of = np.concatenate([rows, rows, left_rows])
            node = np.concatenate([gone, i, left]) + leaves
            while node[0] > 1:
                node >>= 1
                tree[of, node] = np.minimum(tree[of, 2 * node], tree[of, 2 * node + 1])
        return token[live].tolist(), live.sum(axis=1)


class Encoder:
    """Encodes whole texts; remembers the ids of a bounded number of pieces."""

    def __init__(self, ranks: dict[bytes, int], pairs: tuple, pattern: str):
        self.merge = Merger(ranks, pairs)
        self.pieces = regex.compile(pattern).findall
        self.known: dict[str, list[int]] = {}

    def encode(self, texts: list[str]) -> list[list[int]]:
        """The ids of some texts, whose new pieces are merged together."""
        cut = [self.pieces(text) for text in texts]
        if len(self.known) >= REMEMBERED:
            self.known.clear()
        known = self.known
        new = [p for p in dict.fromkeys(chain.from_iterable(cut)) if p not in known]
        known.update(zip(new, self.merge([p.encode() for p in new]), strict=True))
        ids = [list(chain.from_iterable(map(known.__getitem__, pieces))) for pieces in cut]
        for piece in new:
            if len(piece) > REMEMBERED_LENGTH:
                del known[piece]
        return ids


def _stretches(texts: list[str]) -> Iterator[list[str]]:
    """Consecutive texts of some TEXT_AT_ONCE characters."""
    part, size = [], 0
    for text in texts:
        part.append(text)
        size += len(text)
        if size >= TEXT_AT_ONCE:
            yield part
            part, size = [], 0
    if part:
        yield part


def encode_documents(
    docs: DataFrame,
    ranks_path: str,
    pattern: str = public_tokenizers.PATTERN,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """(doc_id, ids) of every row, ids as the tiktoken library's ``encode_ordinary`` gives them.

    ``ranks_path`` is read on the driver; the table, bounded by the vocabulary, is
    broadcast. A match of ``pattern`` that is a token itself is one id, others are merged from
    their bytes, lowest rank first, leftmost on ties. A null text counts as empty
    and has no ids; null ids, repeated rows and an empty table come out as they are; very long
    pieces cost n log n. Other columns are not read.
    """
    prepare(docs.sparkSession)
    ranks = read_ranks(ranks_path)
    shared = docs.sparkSession.sparkContext.broadcast((ranks, pair_table(ranks)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = Encoder(*shared.value, pattern).encode
        for batch in batches:
            at = 0
            for part in _stretches([text or "" for text in batch.column(1).to_pylist()]):
                found = encode(part)
                sizes = np.fromiter(map(len, found), np.int64, len(found))
                flat = np.fromiter(chain.from_iterable(found), np.int32, int(sizes.sum()))
                offsets = pa.array(np.append(0, np.cumsum(sizes)), pa.int32())
                ids = pa.ListArray.from_arrays(offsets, pa.array(flat, pa.int32()))
                own = batch.column(0).slice(at, len(part))
                yield pa.RecordBatch.from_arrays([own, ids], ["doc_id", "ids"])
                at += len(part)

    rows = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInArrow(run, "doc_id bigint, ids array<int>")


def decode_column(docs: DataFrame, ranks_path: str, ids: str = "ids") -> Column:
    """The bytes that the ids of a column stand for; null for null."""
    ranks = docs.sparkSession.sparkContext.broadcast(read_ranks(ranks_path))

    @F.pandas_udf("binary")
    def decode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        token = {i: token for token, i in ranks.value.items()}.__getitem__
        for batch in batches:
            yield pd.Series(
                [None if x is None else b"".join(map(token, x.tolist())) for x in batch],
                dtype=object,
            )

    return decode(F.col(ids))


def digests(docs: DataFrame, ranks_path: str, keep_ids: bool = False) -> DataFrame:
    """Per row the number of ids, and digests of the ids and of the text that they decode to."""
    encoded = encode_documents(docs, ranks_path)
    return encoded.withColumn("decoded", decode_column(docs, ranks_path)).select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
        *(["ids"] if keep_ids else []),
    )


def op8_bpe(spark, sf_dir):
    return digests(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.tiktoken"))
