"""Benchmark passages in training text, found by suffix arrays over shards of the text."""

from __future__ import annotations

import pickle
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from anchorctx.llm.common import documents, row_key, saved, without_keys

# Text that one suffix array covers, and benchmark words of one block.
SHARD_BYTES = 4 << 20
BLOCK_WORDS = 1 << 18
# Occurrences whose lengths are found at a time.
AT_ONCE = 1 << 16
# Bytes of an item that are hashed at a time.
STRETCH = 4 << 20

SPANS = "array<struct<start:int,end:int>>"
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
IN_WORD = np.array([b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 for b in range(256)])
# Each byte stands for a number drawn by its own hash in the words' polynomials.
BYTE_VALUES = np.array([xxhash.xxh64_intdigest(bytes([b]), 1) for b in range(256)], dtype=np.uint64)
BASE = 0x9E3779B97F4A7C15

def _powers(base: int, size: int) -> np.ndarray:
    """base**i modulo 2**64 for i below ``size``."""
    table = np.full(size, base, dtype=np.uint64)
    table[0] = 1
    return np.multiply.accumulate(table)


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit hash of each word of all the texts, none of them 0, and the text it is in."""
    data = b"\0".join(texts).translate(LOWER) + b"\0"
    raw = np.frombuffer(data, dtype=np.uint8)
    inside = IN_WORD[raw]
    edges = np.flatnonzero(np.diff(inside, prepend=False))
    starts, ends = edges[::2], edges[1::2]
    sums = np.zeros(len(raw) + 1, dtype=np.uint64)
    np.cumsum(BYTE_VALUES[raw] * _powers(BASE, len(raw)), out=sums[1:])
    hashes = (sums[ends] - sums[starts]) * _powers(pow(BASE, -1, 1 << 64), len(raw))[starts]
    hashes ^= hashes >> np.uint64(32)
    hashes *= np.uint64(BYTE_VALUES[1] | np.uint64(1))
    hashes ^= hashes >> np.uint64(29)
    text_ends = np.cumsum(np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts)))
    return np.maximum(hashes, np.uint64(1)), np.searchsorted(text_ends, starts, "right")


def suffix_array(words: np.ndarray, depth: int) -> np.ndarray:
    """Positions of ``words`` in the order of their suffixes' first ``depth`` words, at least.

    Prefix doubling; after the first round only suffixes that still share a rank are sorted.
    """
    n = len(words)
    order = np.argsort(words)
    arranged = words[order]
    first = np.ones(n, dtype=bool)
    first[1:] = arranged[1:] != arranged[:-1]
    group = np.maximum.accumulate(np.where(first, np.arange(n), 0))
    rank = np.empty(n, dtype=np.int64)
    rank[order] = group
    known = 1
    while known < depth:
        alone = first.copy()
        alone[:-1] &= first[1:]
        at = np.flatnonzero(~alone)
        if not len(at):
            break
        position = order[at]
        follows = position + known
        second = np.where(follows < n, rank[np.minimum(follows, n - 1)] + 1, 0)
        key = (group[at] << 32) | second
        arrangement = np.argsort(key)
        key = key[arrangement]
        order[at] = position[arrangement]
        starts = np.ones(len(at), dtype=bool)
        starts[1:] = key[1:] != key[:-1]
        first[at] = starts
        group[at] = np.maximum.accumulate(np.where(starts, at, 0))
        rank[order[at]] = group[at]
        known *= 2
    return order


class Block:
    """Benchmark items, or a piece of one, whose windows are searched for together.

    A long item is cut into pieces with ``window`` - 1 words in common, so that each of its windows
    is in one piece. ``before`` is the word before the piece, 0 at the beginning of items;
    ``cut`` tells that the item goes on in the next block.
    """

    def __init__(
        self, item_ids: list, words: list[np.ndarray], window: int, before: int = 0, cut: bool = False
    ):
        hashes = np.concatenate([np.zeros(0, np.uint64), *words])
        counts = np.fromiter(map(len, words), np.int64, len(words))
        item = np.repeat(np.arange(len(words)), counts)
        left = np.cumsum(counts)[item] - np.arange(len(hashes))
        length = np.minimum(counts[item], window)
        self.window, self.before, self.cut = window, before, cut
        self.item_ids = [None if i is None else str(i) for i in item_ids]
        # Zeros around each item stand for its ends; no word has hash 0.
        place = 1 + np.arange(len(hashes)) + item * window
        self.words = np.zeros(1 + len(hashes) + (len(words) + 1) * window, np.uint64)
        self.words[0], self.words[place] = before, hashes
        self.end = 1 + len(hashes)  # of the item, where it is the only one
        self.starts = place[left >= length]
        lengths = length[left >= length]
        self.items = item[left >= length]
        rows = self.words[self.starts[:, None] + np.arange(window)]
        rows[np.arange(window) >= lengths[:, None]] = 0
        # Equal windows are searched for once: by_window lists the starts of each.
        self.patterns, which = np.unique(rows, axis=0, return_inverse=True)
        which = which.reshape(-1)
        self.by_window = np.argsort(which, kind="stable")
        self.first = np.searchsorted(which[self.by_window], np.arange(len(self.patterns) + 1))
        self.pattern_lengths = (self.patterns != 0).sum(axis=1)


def _bounds(words: np.ndarray, order: np.ndarray, block: Block) -> tuple[np.ndarray, np.ndarray]:
    """For each pattern, where the suffixes that begin with it start and end in ``order``."""
    columns = np.arange(block.window)
    unused = block.patterns == 0
    found = []
    for past_equal in (False, True):
        low = np.zeros(len(block.patterns), dtype=np.int64)
        high = np.full(len(block.patterns), len(order), dtype=np.int64)
        while len(open_ := np.flatnonzero(low < high)):
            middle = (low[open_] + high[open_]) >> 1
            here = words[order[middle][:, None] + columns]
            wanted = block.patterns[open_]
            differs = (here != wanted) & ~unused[open_]
            at = differs.argmax(axis=1)
            line = np.arange(len(open_))
            below = here[line, at] < wanted[line, at]
            below = np.where(differs[line, at], below, past_equal)
            low[open_] = np.where(below, middle + 1, low[open_])
            high[open_] = np.where(below, high[open_], middle)
        found.append(low)
    return found[0], found[1]


def _expanded(first: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For ranges (first, first + count): the range of each member, and the member."""
    which = np.repeat(np.arange(len(counts)), counts)
    begin = np.cumsum(counts) - counts
    return which, np.arange(len(which)) - begin[which] + first[which]


def _lengths(words: np.ndarray, at: np.ndarray, other: np.ndarray, start: np.ndarray) -> np.ndarray:
    """How many words from ``at`` on equal those of ``other`` from ``start`` on; both end in zeros."""
    length = np.zeros(len(at), dtype=np.int64)
    going, step = np.arange(len(at)), 16
    while len(going):
        columns = np.arange(step)
        here = words[np.minimum((at[going] + length[going])[:, None] + columns, len(words) - 1)]
        there = other[np.minimum((start[going] + length[going])[:, None] + columns, len(other) - 1)]
        same = (here == there) & (here != 0)
        run = np.where(same.all(axis=1), step, same.argmin(axis=1))
        length[going] += run
        going = going[run == step]
        step = max(16, min(2 * step, AT_ONCE * 16 // max(1, len(going))))
    return length


def search(texts: list[bytes], blocks: Iterable[Block], window: int) -> pd.DataFrame:
    """One row per text: its words, and spans, items and the longest match found in it.

    The suffix array is made once for all blocks. A longest match begins where the
    words before differ, so only such occurrences are followed to their ends, from piece to piece of an item.
    """
    hashes, text = word_hashes(texts)
    counts = np.bincount(text, minlength=len(texts))
    offsets = np.cumsum(counts + 1) - counts - 1
    size = len(hashes) + len(texts)
    # A zero after each text, and enough at the end for every comparison.
    words = np.zeros(size + window + 1, dtype=np.uint64)
    words[np.arange(len(hashes)) + text] = hashes
    of = np.repeat(np.arange(len(texts)), counts + 1)
    order = suffix_array(words[:size], window) if len(hashes) else np.zeros(0, np.int64)
    cover = np.zeros(size + 1, dtype=np.int64)
    named: list[list] = [[] for _ in texts]
    longest = np.zeros(len(texts), dtype=np.int64)
    longest_at = np.zeros(len(texts), dtype=np.int64)
    longest_item: list = [None] * len(texts)
    # Matches up to the end of a piece: where they began, and how long they are so far.
    open_at = open_length = np.zeros(0, dtype=np.int64)

    def met(block: Block, at: np.ndarray, length: np.ndarray, item: np.ndarray) -> None:
        """Of a text's matches the longest counts, of equal ones the first."""
        best = np.lexsort((at, -length))
        t, first = np.unique(of[at[best]], return_index=True)
        best = best[first]
        better = length[best] > longest[t]
        t, best = t[better], best[better]
        longest[t], longest_at[t] = length[best], at[best] - offsets[t]
        for one, i in zip(t.tolist(), item[best].tolist(), strict=True):
            longest_item[one] = block.item_ids[i]

    for block in blocks:
        if not len(hashes) or not len(block.patterns):
            continue
        going_at, going_length = [], []
        if len(open_at):
            # The pieces have these words in common.
            start = np.full(len(open_at), 1 + window - 1)
            more = _lengths(words, open_at + open_length, block.words, start)
            met(block, open_at, open_length + more, np.zeros(len(open_at), np.int64))
            on = (start + more == block.end) & block.cut
            going_at.append(open_at[on])
            going_length.append((open_length + more)[on])
        low, high = _bounds(words, order, block)
        found, member = _expanded(low, high - low)
        position = order[member]
        np.add.at(cover, position, 1)
        np.add.at(cover, position + block.pattern_lengths[found], -1)
        seen, items = len(block.patterns), len(block.item_ids)
        each = np.diff(block.first)
        pairs = np.unique(of[position].astype(np.int64) * seen + found)
        line, entry = _expanded(block.first[pairs % seen], each[pairs % seen])
        pairs = np.unique((pairs // seen)[line] * items + block.items[block.by_window[entry]])
        for t, i in zip((pairs // items).tolist(), (pairs % items).tolist(), strict=True):
            if block.item_ids[i] is not None:
                named[t].append(block.item_ids[i])
        # Parts of some AT_ONCE pairs of an occurrence and a place in the benchmark.
        part = (np.cumsum(each[found]) - each[found]) // AT_ONCE
        edges = np.flatnonzero(np.diff(part, prepend=-1, append=-1))
        for begin, end in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
            line, entry = _expanded(block.first[found[begin:end]], each[found[begin:end]])
            which = block.by_window[entry]
            at, start = position[begin:end][line], block.starts[which]
            # The word before the first text is the zero at the end.
            back = words[at - 1]
            maximal = (back == 0) | (back != block.words[start - 1])
            at, start, item = at[maximal], start[maximal], block.items[which[maximal]]
            length = _lengths(words, at, block.words, start)
            met(block, at, length, item)
            on = (start + length == block.end) & block.cut
            going_at.append(at[on])
            going_length.append(length[on])
        none = [np.zeros(0, np.int64)]
        open_at, open_length = (np.concatenate(none + x) for x in (going_at, going_length))

    spans: list[list] = [[] for _ in texts]
    edges = np.flatnonzero(np.diff(np.cumsum(cover) > 0, prepend=False))
    for start, end in zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True):
        t = of[start]
        spans[t].append({"start": int(start - offsets[t]), "end": int(end - offsets[t])})
    return pd.DataFrame(
        {
            "n_words": counts.astype(np.int64),
            "spans": spans,
            "items": named,
            "longest": longest,
            "longest_at": longest_at,
            "longest_item": longest_item,
        }
    )


def _item_words(body: bytes) -> np.ndarray:
    """Hashes of an item's words, some megabytes at a time, cut between words."""
    found, at = [], 0
    while at < len(body):
        end = min(at + STRETCH, len(body))
        while end < len(body) and IN_WORD[LOWER[body[end]]]:
            end += 1
        found.append(word_hashes([body[at:end]])[0])
        at = end
    return np.concatenate([np.zeros(0, np.uint64), *found])


def item_blocks(items: Iterable[tuple], window: int, block_words: int) -> Iterator[Block]:
    """Blocks of some ``block_words`` words from items (id, text); longer items are cut."""
    ids, held, size = [], [], 0
    for item, body in items:
        words = _item_words(body)
        if len(words) <= max(block_words, window):
            ids.append(item)
            held.append(words)
            size += len(words)
            if size < block_words:
                continue
        if ids:
            yield Block(ids, held, window)
            ids, held, size = [], [], 0
        if len(words) > max(block_words, window):
            starts = len(words) - window + 1
            for at in range(0, starts, block_words):
                end = min(at + block_words, starts) + window - 1
                before = words[at - 1] if at else 0
                yield Block([item], [words[at:end]], window, before, end < len(words))
    if ids:
        yield Block(ids, held, window)


def _blocks(benchmark: DataFrame, item_id: str, text: str, window: int, block_words: int):
    """The benchmark's blocks, made by tasks; one task's are in the driver at a time."""
    rows = benchmark.select(
        F.col(item_id).cast("string").alias("item"),
        F.coalesce(F.col(text), F.lit("")).cast("binary").alias("body"),
    )
    # A word and what is around it have two bytes or more.
    size = rows.agg(F.sum(F.octet_length("body"))).first()[0] or 0

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        items = (row for batch in batches for row in batch.itertuples(index=False, name=None))
        for block in item_blocks(items, window, block_words):
            yield pd.DataFrame({"block": [pickle.dumps(block, protocol=5)]})

    # Few items in each of many partitions would be as many blocks.
    made = rows.coalesce(size // 2 // block_words + 1).mapInPandas(run, "block binary")
    for (block,) in made.toLocalIterator():
        yield benchmark.sparkSession.sparkContext.broadcast(bytes(block))


def _searched(rows: DataFrame, blocks: list, window: int) -> DataFrame:
    def loaded() -> Iterator[Block]:
        """The blocks one after the other; the worker keeps none of them but a single one."""
        for shared in blocks:
            yield pickle.loads(shared.value)
            if len(blocks) > 1:
                vars(shared).pop("_value", None)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        kept = list(loaded()) if len(blocks) == 1 else None
        for batch in batches:
            batch = batch.reset_index(drop=True)
            sizes = np.cumsum(batch["body"].str.len().to_numpy())
            shard = (sizes - 1).clip(0) // SHARD_BYTES
            for _, part in batch.groupby(shard, sort=True):
                part = part.reset_index(drop=True)
                found = search(part["body"].tolist(), loaded() if kept is None else kept, window)
                yield pd.concat([part.drop(columns="body"), found], axis=1)

    return rows.mapInPandas(
        run,
        f"doc_id bigint, row_key bigint, n_words bigint, spans {SPANS},"
        " items array<string>, longest bigint, longest_at bigint, longest_item string",
    )


def _covered(spans: str) -> Column:
    """Words in the union of spans."""
    return F.expr(
        f"""
        aggregate(
            array_sort({spans}),
            named_struct('words', 0L, 'upto', 0),
            (a, s) -> named_struct(
                'words', a.words + greatest(0, s.end - greatest(s.start, a.upto)),
                'upto', greatest(a.upto, s.end)
            ),
            a -> a.words
        )
        """
    )


def benchmark_matches(
    docs: DataFrame,
    benchmark: DataFrame,
    *,
    window: int = 10,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """Which words of each document lie in a passage of ``window`` words of a benchmark item.

    Words are runs of digits, letters a-z and characters beyond ASCII, A-Z taken in lower case. An
    item of fewer words than ``window`` is one passage, one without words none. A row per document:
    doc_id, row_key, n_words, ``spans`` (of hit words, end exclusive), ``items`` (ids found, each
    once), n_hit, and the longest verbatim match: its words, first word and item.

    Each batch of documents, some megabytes, gets a suffix array over hashes of its words, in
    which every suffix of the benchmark is looked up by binary search. Tasks make blocks of some
    ``block_words`` words of the benchmark and cut longer items; a task over documents goes through all blocks, one
    in memory at a time, so the documents are read and their suffixes sorted once. Each block is
    broadcast by itself, its size bounded by ``block_words``; together they take some 100 bytes a
    benchmark word of an executor's disk. Words are told apart by 64-bit hashes. Of longest matches of equal length
    the first in the text counts, then the first in the benchmark's blocks.

    Null texts have no words, an item without id hits words but is not listed, ids in several
    items count once, repeated documents come out as often as they came in, and an empty
    table of documents or items gives no rows or no hits. Other columns are not read.
    """
    rows = docs.select(
        F.col(doc_id).cast("bigint").alias("doc_id"),
        row_key(doc_id, text).alias("row_key"),
        F.coalesce(F.col(text), F.lit("")).cast("binary").alias("body"),
    )
    blocks = list(_blocks(benchmark, item_id, item_text, window, block_words))
    result = saved(_searched(rows, blocks, window), "benchmark-hits")
    for block in blocks:
        block.destroy()
    return result.withColumn("items", F.array_sort(F.array_distinct("items"))).withColumn(
        "n_hit", _covered("spans")
    )


def decontaminate(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """``docs`` without the documents in which a benchmark passage occurs.

    All columns are kept as they are; columns of other names, such as those of the benchmark or of
    the matches, may occur in ``docs``. Documents without text or words stay, rows equal in id and text
    stay or go together, null ids are ids like any other, and an empty benchmark keeps everything.
    """
    hit = benchmark_matches(docs, benchmark, **options).where("n_hit > 0")
    return without_keys(docs, hit, options.get("doc_id", "doc_id"), options.get("text", "text"))


def op10_benchmark_hits(spark, sf_dir):
    matches = benchmark_matches(
        documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    )
    return matches.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


WORDS_SQL = r"""
    coalesce(regexp_extract_all(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), [])
"""
# Every window of the documents spelled out.
ORACLE_SQL = f"""
with doc as (select row_number() over () as r, doc_id, {WORDS_SQL} as w from documents),
item as (
    select item_id, w, least(10, len(w)) as size
    from (select item_id, {WORDS_SQL} as w from benchmark) where len(w) > 0
),
passage as (
    select distinct item_id, size, array_to_string(w[i : i + size - 1], ' ') as words
    from (select *, unnest(range(1, len(w) - size + 2)) as i from item)
),
place as (
    select r, size, i, array_to_string(w[i : i + size - 1], ' ') as words
    from (
        select *, unnest(range(1, len(w) - size + 2)) as i
        from doc cross join (select distinct size from passage)
    )
),
hit as (select r, item_id, size, i from place join passage using (size, words)),
hit_words as (
    select r, count(*) as n_hit
    from (select distinct r, unnest(range(i, i + size)) as at from hit) group by r
),
hit_items as (
    select r, count(*) as n_items, string_agg(item_id, ',' order by item_id) as ids
    from (select distinct r, cast(item_id as varchar) as item_id from hit
          where item_id is not null)
    group by r
)
select doc_id, cast(len(w) as bigint) as n_words, coalesce(n_hit, 0) as n_hit,
       coalesce(n_items, 0) as n_items, sha256(coalesce(ids, '')) as items_sha256,
       coalesce(n_hit, 0) > 0 as contaminated
from doc left join hit_words using (r) left join hit_items using (r)
"""
