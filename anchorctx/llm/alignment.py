"""Alignment of two tokenizers: groups of tokens that cover the same bytes, and their links."""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import public_tokenizers
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from anchorctx.llm.common import discard, documents, prepare, saved, shuffles_removed

# Characters of texts that are aligned together and share one list of pairs.
CHUNK = 1 << 20
# A group with more links than this counts its distinct ids before it pairs them.
EXPANDED = 4096
WORD_START = "▁"
MARKS = ";,|"
# The pattern that cuts texts walks back over white space; runs of that length go another way.
LONG_SPACE = re.compile(r"\s{500}")
# How a byte-level vocabulary that cuts texts by public_tokenizers.PATTERN says so.
BYTE_LEVEL = {"type": "ByteLevel", "add_prefix_space": False, "use_regex": True}

_KEPT = {
    "doc_id": pa.int64(), "n_a": pa.int64(), "n_b": pa.int64(), "n_groups": pa.int64(),
    "n_links": pa.int64(), "groups_sha256": pa.string(),
}
_ROWS = "array<struct<doc_id: bigint, n_a: bigint, n_b: bigint, n_groups: bigint, n_links: bigint, groups_sha256: string>>"
# `pairs`: distinct id pairs of the chunk, `held`: how many of its documents hold each.
# `ends`: where the links of each document end in `link` (places in `pairs`) and `times`.
CHUNKS = (
    f"chunk string, rows {_ROWS}, pairs array<bigint>, held array<bigint>,"
    " ends binary, link binary, times binary"
)


def byte_letters() -> dict[str, int]:
    """The character that stands for each byte in the pieces of a byte-level vocabulary."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(256 + n): b for n, b in enumerate(others)}


class Aligner:
    """Encodes texts by two vocabularies, given as the contents of their files."""

    def __init__(self, bpe_json: bytes, piece_model: bytes):
        # A task has one core; threads of its own would only wait for each other.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        settings = json.loads(bpe_json)
        cut = settings["pre_tokenizer"] or {}
        if settings["normalizer"] or any(cut.get(key) != value for key, value in BYTE_LEVEL.items()):
            raise ValueError("the first vocabulary is not a plain byte-level one")
        self.a = Tokenizer.from_str(bpe_json.decode())
        self.a.encode_special_tokens = True
        self.b = SentencePieceProcessor(model_proto=piece_model)
        letter = byte_letters()
        self.bytes_a: list[bytes] = [b""] * self.a.get_vocab_size()
        for token, i in self.a.get_vocab().items():
            known = all(c in letter for c in token)
            self.bytes_a[i] = bytes(map(letter.__getitem__, token)) if known else token.encode()
        self.ranked = self._ranked(settings)
        self.bytes_b = [self._piece_bytes(i) for i in range(self.b.get_piece_size())]
        self.size_a = np.array(list(map(len, self.bytes_a)))
        self.size_b = np.array(list(map(len, self.bytes_b)))
        # Ids as they are written behind each mark, a row each, filled up with zeros.
        self.count = max(len(self.bytes_a), len(self.bytes_b))
        width = len(str(self.count)) + 1
        rows = [f"{mark}{i}".encode().ljust(width, b"\0") for mark in MARKS for i in range(self.count)]
        self.digits = np.frombuffer(b"".join(rows), np.uint8).reshape(-1, width)

    def _piece_bytes(self, i: int) -> bytes:
        piece = self.b.id_to_piece(i)
        if self.b.is_byte(i):
            return bytes([int(piece[3:-1], 16)])
        return piece.replace(WORD_START, " ").encode()

    def _ranked(self, settings: dict) -> tiktoken.Encoding:
        """The same vocabulary by ranks: ids, if each merge makes the next higher one."""
        merges = settings["model"]["merges"]
        made = ["".join(m.split(" ") if isinstance(m, str) else m) for m in merges]
        ids = [settings["model"]["vocab"][token] for token in made]
        if ids != sorted(ids):
            raise ValueError("the first vocabulary does not number its tokens in the order of its merges")
        special = {token["id"] for token in settings["added_tokens"]}
        return tiktoken.Encoding(
            "ranked",
            pat_str=public_tokenizers.PATTERN,
            mergeable_ranks={token: i for i, token in enumerate(self.bytes_a) if i not in special},
            special_tokens={},
        )

    def _encode_a(self, text: str) -> list[int]:
        """Ids by A: the same either way, but one takes a fourth of the time and fails at long runs."""
        if LONG_SPACE.search(text):
            return self.a.encode(text, add_special_tokens=False).ids
        return self.ranked.encode_ordinary(text)

    def encode(self, texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray] | None]:
        """Ids of each text by A, behind a space, and by B; None where their bytes differ from it."""
        for text, b in zip(texts, self.b.encode(texts, num_threads=1), strict=True):
            if not text:
                yield None
                continue
            body = (" " + text).encode()
            a = self._encode_a(" " + text)
            a, b = np.array(a, np.int64), np.array(b, np.int64)
            # A byte-level vocabulary can write every byte, and nothing else than the text.
            same = self.size_a[a].sum() == len(body) == self.size_b[b].sum()
            same = same and b"".join(map(self.bytes_b.__getitem__, b.tolist())) == body
            yield (a, b) if same else None

    def groups(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """How many tokens of A and of B each group has.

        A dictionary per side leads from the byte where a token ends to its index; ends found
        in both dictionaries, in order, cut the id lists.
        """
        index_a = dict(zip(self.size_a[a].cumsum().tolist(), range(1, len(a) + 1), strict=True))
        index_b = dict(zip(self.size_b[b].cumsum().tolist(), range(1, len(b) + 1), strict=True))
        common = sorted(index_a.keys() & index_b.keys())
        cut_a = np.fromiter(map(index_a.__getitem__, common), np.int64, len(common))
        cut_b = np.fromiter(map(index_b.__getitem__, common), np.int64, len(common))
        return np.diff(cut_a, prepend=0), np.diff(cut_b, prepend=0)

    def written(self, a: np.ndarray, b: np.ndarray, in_a: np.ndarray, in_b: np.ndarray) -> bytes:
        """``a1,a2|b1;a3|b2,b3``: the ids of each group."""
        start_a, start_b = (np.cumsum(n) - n for n in (in_a, in_b))
        of_a, of_b = (ids + MARKS.index(",") * self.count for ids in (a, b))
        of_a[start_a] = a[start_a] + MARKS.index(";") * self.count
        of_b[start_b] = b[start_b] + MARKS.index("|") * self.count
        row = np.empty(len(a) + len(b), np.int64)
        row[np.arange(len(a)) + np.repeat(start_b, in_a)] = of_a
        row[np.arange(len(b)) + np.repeat(start_a + in_a, in_b)] = of_b
        found = self.digits[row].ravel()
        return found[found != 0][1:].tobytes()


def links(
    a: np.ndarray, b: np.ndarray, in_a: np.ndarray, in_b: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (A id << 32 | B id) linked in a text, and how often: each A with each B of a group."""
    start_a, start_b = np.cumsum(in_a) - in_a, np.cumsum(in_b) - in_b
    many = in_a * in_b
    few = many <= EXPANDED
    sizes = many[few]
    group = np.repeat(np.flatnonzero(few), sizes)
    place = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    found = [a[start_a[group] + place // in_b[group]] << 32 | b[start_b[group] + place % in_b[group]]]
    times = [np.ones(len(group), np.int64)]
    for g in np.flatnonzero(~few):
        own_a, times_a = np.unique(a[start_a[g] : start_a[g] + in_a[g]], return_counts=True)
        own_b, times_b = np.unique(b[start_b[g] : start_b[g] + in_b[g]], return_counts=True)
        found.append((own_a[:, None] << 32 | own_b).ravel())
        times.append((times_a[:, None] * times_b).ravel())
    pairs, at = np.unique(np.concatenate(found), return_inverse=True)
    return pairs, np.bincount(at, np.concatenate(times), len(pairs)).astype(np.int64)


_loaded: dict[str, Aligner] = {}


def _aligner(files: tuple[bytes, bytes]) -> Aligner:
    """One per worker and pair of files: reading a vocabulary takes a good part of a second."""
    name = hashlib.sha256(files[0] + files[1]).hexdigest()
    if name not in _loaded:
        _loaded.clear()
        _loaded[name] = Aligner(*files)
    return _loaded[name]


def _parts(ids: list, texts: list[str]) -> Iterator[tuple[list, list[str]]]:
    """Consecutive rows of some CHUNK characters; a longer text is a part of its own."""
    start, size = 0, 0
    for end, text in enumerate(texts):
        if size and size + len(text) > CHUNK:
            yield ids[start:end], texts[start:end]
            start, size = end, 0
        size += len(text)
    if texts:
        yield ids[start:], texts[start:]


def _chunk(aligner: Aligner, name: str, ids: list, texts: list[str]) -> dict:
    rows, found, counted = [], [], []
    for doc_id, both in zip(ids, aligner.encode(texts), strict=True):
        if both is None:
            rows.append((doc_id, 0, 0, 0, 0, ""))
            pairs = times = np.zeros(0, np.int64)
        else:
            a, b = both
            in_a, in_b = aligner.groups(a, b)
            digest = hashlib.sha256(aligner.written(a, b, in_a, in_b)).hexdigest()
            rows.append((doc_id, len(a), len(b), len(in_a), int((in_a * in_b).sum()), digest))
            pairs, times = links(a, b, in_a, in_b)
        found.append(pairs)
        counted.append(times)
    pairs, link = np.unique(np.concatenate(found), return_inverse=True)
    return {
        "chunk": name,
        "rows": [dict(zip(_KEPT, row, strict=True)) for row in rows],
        "pairs": pairs,
        "held": np.bincount(link, minlength=len(pairs)),
        "ends": np.cumsum([len(x) for x in found], dtype=np.int64).tobytes(),
        "link": link.astype(np.int32).tobytes(),
        "times": np.concatenate(counted).astype(np.int64).tobytes(),
    }


_ARROW = pa.schema(
    {
        "chunk": pa.string(),
        "rows": pa.list_(pa.struct(list(_KEPT.items()))),
        "pairs": pa.list_(pa.int64()),
        "held": pa.list_(pa.int64()),
        "ends": pa.binary(),
        "link": pa.binary(),
        "times": pa.binary(),
    }
)


def aligned_chunks(
    docs: DataFrame, bpe_json: str, piece_model: str, *, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """CHUNKS: documents some at a time, with their groups counted and their links by pair."""
    prepare(docs.sparkSession)
    files = docs.sparkSession.sparkContext.broadcast(
        tuple(open(path, "rb").read() for path in (bpe_json, piece_model))
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner, task, number = _aligner(files.value), TaskContext.get().partitionId(), 0
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            for ids, part in _parts(batch.column(0).to_pylist(), texts):
                found = _chunk(aligner, f"{task}-{number}", ids, part)
                number += 1
                yield pa.RecordBatch.from_pylist([found], _ARROW)

    rows = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInArrow(run, CHUNKS)


def pair_counts(chunks: DataFrame) -> DataFrame:
    """(a, b, n, best): documents that hold each id pair linked; whether none of its A id's has more."""
    held = F.explode(F.arrays_zip("pairs", "held")).alias("p")
    counts = saved(
        chunks.select(held).select("p.pairs", "p.held")
        .groupBy("pairs").agg(F.sum("held").alias("n"))
        .select(
            F.shiftright("pairs", 32).cast("int").alias("a"),
            F.col("pairs").bitwiseAND(F.lit(0xFFFFFFFF)).cast("int").alias("b"),
            "n",
        ),
        "alignment-counts",
    )
    most = saved(counts.groupBy("a").agg(F.max("n").alias("most")), "alignment-most")
    return counts.join(most, "a").select("a", "b", "n", (F.col("n") == F.col("most")).alias("best"))


def align_documents(
    docs: DataFrame, bpe_json: str, piece_model: str, *, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) of every row.

    Texts are encoded by A, the byte-level BPE of the file ``bpe_json``, behind a space, and
    by B, the piece model of the file ``piece_model``, which adds the space; special tokens in a
    text are plain text. Ends of tokens, in bytes, that both have cut them into groups, and a group links each
    of its A tokens with each of its B tokens. A pair of ids counts the documents that hold it
    linked; ``n_best`` are links whose pair no other pair of the A id outnumbers, ``count_sum`` adds up the counts.

    Texts that are null, empty, or not what the joined tokens say have no tokens: zeros and an empty
    digest. Null ids, repeated rows (each is a document of its own) and an empty table come out as they
    are; other columns are not read.

    Documents are worked on in chunks, and only a chunk's distinct pairs are shuffled; the counts come back
    to a chunk by a join on the pair, so that a frequent pair has a row per chunk and not per document. What
    a task holds is a chunk, or one longer document. The two files are read on the driver and broadcast;
    their size is that of the vocabularies.
    """
    found = saved(aligned_chunks(docs, bpe_json, piece_model, doc_id=doc_id, text=text), "alignment-chunks")
    with shuffles_removed(docs.sparkSession):
        counts = saved(
            pair_counts(found).select(
                (F.shiftleft(F.col("a").cast("bigint"), 32) + F.col("b")).alias("pair"), "n", "best"
            ),
            "alignment-pairs",
        )
        back = saved(
            found.select("chunk", F.posexplode("pairs").alias("at", "pair"))
            .join(counts, "pair")
            .groupBy("chunk")
            .agg(F.sort_array(F.collect_list(F.struct("at", "n", "best"))).alias("scored"))
            .select("chunk", F.col("scored.n").alias("n"), F.col("scored.best").alias("best")),
            "alignment-scored",
        )
    discard(counts)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                yield _summed(*(column[row] for column in batch.columns))

    return found.join(back, "chunk", "left").select("rows", "n", "best", "ends", "link", "times").mapInArrow(
        run, "doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_best bigint,"
        " count_sum bigint, groups_sha256 string"
    )


def _summed(rows, n, best, ends, link, times) -> pa.RecordBatch:
    """The rows of a chunk with the sums over their links."""
    ends, times = (np.frombuffer(x.as_buffer(), np.int64) for x in (ends, times))
    link = np.frombuffer(link.as_buffer(), np.int32)

    def per_row(values) -> np.ndarray:
        if values is None:
            return np.zeros(len(ends), np.int64)
        values = values.to_numpy(zero_copy_only=False).astype(np.int64)
        return np.diff(np.append(0, np.cumsum(values[link] * times))[ends], prepend=0)

    fields = rows.values
    columns = {name: fields.field(name) for name in _KEPT}
    columns |= {"n_best": pa.array(per_row(best.values)), "count_sum": pa.array(per_row(n.values))}
    order = [*list(_KEPT)[:-1], "n_best", "count_sum", "groups_sha256"]
    return pa.RecordBatch.from_arrays([columns[name] for name in order], order)


def op12_alignment(spark, sf_dir):
    files = (public_tokenizers.path(name) for name in ("byte_bpe_50k.json", "piece_bpe_32k.model"))
    return align_documents(documents(spark, sf_dir), *files)
