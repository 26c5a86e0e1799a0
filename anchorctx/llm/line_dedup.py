"""Fuzzy line dedup: MinHash bands, exact Jaccard similarity, one line per component."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from anchorctx.llm.common import (
    connected_components,
    discard,
    documents,
    row_key,
    saved,
    shuffles_removed,
    text_or_empty,
    unused,
)

# Characters of a shingle, a power of two. Four, so that a character changed inside a line of forty
# leaves it near: the change spoils four shingles, and (37 - 4) / (37 + 4) is 0.805.
SHINGLE = 4
SIMILARITY = 0.8
BANDS, ROWS = 14, 6
SEED = 42
# A blank line, for Spark and for Python alike.
BLANK = r"^[\x20\t\x0B\f\r]*$"
# Text whose distinct lines are collected, and characters whose signatures are made, at a time.
TEXT_AT_ONCE = 2 << 20
# Lines that a task remembers to have passed on, so that common lines are not passed on by each stretch.
REMEMBERED = 1 << 18
SIGNED_AT_ONCE = 1 << 15
# Bands travel in rows of a bucket and a stretch; a task has a bucket's bands, this many new ones at a time.
BUCKET_BITS = 12
BANDS_AT_ONCE = 1 << 20
# Rows of buckets, and pairs, that are compared in one call, so that arrays stay in the cache,
# and characters of the lines of such rows.
SLOT_ROWS = 1024
SLOT_CHARACTERS = 1 << 20
PAIRS_AT_ONCE = 256
# Lines whose sketches are made, and pairs of rows whose sketches are compared, at a time; bits of a sketch.
SKETCHED_AT_ONCE = 128
COMPARED_AT_ONCE = 1 << 14
SKETCH_BITS = 512
# Bits of the filter that spares lines without candidates a shuffle, and words of a slab of it.
FILTER_BITS = 1 << 27
SLAB = 1 << 13
EMPTY = np.uint64(0xFFFFFFFF)
ODD = [np.uint64(xxhash.xxh64_intdigest(bytes([i]), 7) | 1) for i in range(BANDS * ROWS + 8)]


def _mixed(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(33))
    h *= ODD[0]
    h ^= h >> np.uint64(29)
    h *= ODD[1]
    h ^= h >> np.uint64(32)
    return h


def _rolled(codes: np.ndarray, size: int) -> np.ndarray:
    """A polynomial of each ``size`` codes, a power of two, by doubling."""
    h, width = codes, 1
    while width < size:
        h = h[:-width] * ODD[2 + width] + h[width:]
        width *= 2
    return h


def _shingle_hashes(lines: list[str], size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the shingles of all lines, repeats included, and the line of each."""
    codes = np.frombuffer("\n".join(lines).encode("utf-32-le"), dtype=np.uint32).astype(np.uint64)
    sizes = np.fromiter(map(len, lines), np.int64, len(lines))
    starts = np.cumsum(sizes + 1) - sizes - 1
    counts = np.maximum(sizes - size + 1, 0)
    which = np.repeat(np.arange(len(lines)), counts)
    at = np.arange(len(which)) + np.repeat(starts - np.cumsum(counts) + counts, counts)
    hashes = _mixed(_rolled(codes, size)[at]) if len(at) else np.zeros(0, np.uint64)
    short = np.flatnonzero(counts == 0)
    whole = np.array(
        [xxhash.xxh64_intdigest(lines[i].encode(), 1) for i in short], dtype=np.uint64
    )
    return np.concatenate([hashes, _mixed(whole)]), np.concatenate([which, short])


def shingle_ids(lines: list[str], size: int = 8) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of each line's distinct shingles, line after line, and how many each line has.

    Equal shingles of the lines have equal numbers, from 0 without gaps.
    """
    hashes, which = _shingle_hashes(lines, size)
    order = np.argsort(hashes)
    arranged = hashes[order]
    ids = np.empty(len(hashes), dtype=np.int64)
    ids[order] = np.cumsum(np.append(False, arranged[1:] != arranged[:-1]))
    total = int(ids.max()) + 1
    pairs = np.sort(which * total + ids)
    pairs = pairs[np.append(True, pairs[1:] != pairs[:-1])]
    which, ids = np.divmod(pairs, total)
    return ids, np.bincount(which, minlength=len(lines))


class Shingled:
    """Lines that are compared with each other by the Jaccard similarity of their shingles."""

    def __init__(self, lines: list[str], similarity: float):
        self.ids, self.sizes = shingle_ids(lines, SHINGLE)
        self.ends = np.cumsum(self.sizes)
        self.marks = np.zeros(int(self.ids.max()) + 1, dtype=np.int32)
        self.similarity = similarity

    def near(self, one: int, others: np.ndarray) -> np.ndarray:
        """Which of the ``others`` are as similar to ``one`` as asked for."""
        sizes = self.sizes[others]
        at = np.cumsum(sizes) - sizes
        places = np.arange(int(sizes.sum())) + np.repeat(self.ends[others] - sizes - at, sizes)
        mine = self.ids[self.ends[one] - self.sizes[one] : self.ends[one]]
        self.marks[mine] = 1
        both = np.add.reduceat(self.marks[self.ids[places]], at)
        self.marks[mine] = 0
        return both >= self.similarity * (sizes + self.sizes[one] - both) - 1e-9


def band_hashes(lines: list[str]) -> np.ndarray:
    """One row per line, one 64-bit hash per band.

    One-permutation MinHash: a shingle's hash names its bin and its value there; a bin
    without shingles takes the value of another bin, found by probing bins in an order
    that is the same for all lines.
    """
    bins = BANDS * ROWS
    hashes, which = _shingle_hashes(lines, SHINGLE)
    bin_ = ((hashes >> np.uint64(32)) * np.uint64(bins)) >> np.uint64(32)
    least = np.full(len(lines) * bins, EMPTY, dtype=np.uint64)
    np.minimum.at(least, which * bins + bin_.astype(np.int64), hashes & np.uint64(0xFFFFFFFE))
    found = least.copy()
    missing = np.flatnonzero(least == EMPTY)
    probe = 0
    while len(missing):
        probe += 1
        other = _mixed((missing % bins + 1).astype(np.uint64) * ODD[2] + np.uint64(probe))
        value = least[missing // bins * bins + (other % np.uint64(bins)).astype(np.int64)]
        found[missing] = value
        missing = missing[value == EMPTY]
    found = found.reshape(len(lines), BANDS, ROWS)
    bands = np.zeros((len(lines), BANDS), dtype=np.uint64)
    for r in range(ROWS):
        bands = _mixed(bands + found[:, :, r] * ODD[3 + r] + np.arange(BANDS, dtype=np.uint64))
    return bands


def sketches(lines: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Each line's number of distinct shingles, and SKETCH_BITS bits: whether an odd number of these
    shingles fall to the bit. Two lines differ in no fewer shingles than their sketches in bits.
    """
    sizes = np.zeros(len(lines), dtype=np.int32)
    bits = np.zeros((len(lines), SKETCH_BITS // 64), dtype=np.int64)
    for at in range(0, len(lines), SKETCHED_AT_ONCE):
        part = lines[at : at + SKETCHED_AT_ONCE]
        hashes, which = _shingle_hashes(part, SHINGLE)
        # One number of the line and 54 bits of the hash, so that one sort does.
        keys = np.sort((which.astype(np.uint64) << np.uint64(54)) | (hashes >> np.uint64(10)))
        keys = keys[np.append(True, keys[1:] != keys[:-1])]
        which = (keys >> np.uint64(54)).astype(np.int64)
        sizes[at : at + len(part)] = np.bincount(which, minlength=len(part))
        place = which * SKETCH_BITS + (keys % np.uint64(SKETCH_BITS)).astype(np.int64)
        odd = np.bincount(place, minlength=len(part) * SKETCH_BITS) & 1
        bits[at : at + len(part)] = np.packbits(odd.astype(bool)).view(np.int64).reshape(len(part), -1)
    return sizes, bits


def _maybe_similar(a: Column, b: Column, similarity: float) -> Column:
    """False only where the sketches prove that two lines are less similar than asked for.

    Lines of m and n shingles that differ in d have the similarity (m + n - d) / (m + n + d).
    """
    differ = sum(
        F.bit_count(a[f"bits{i}"].bitwiseXOR(b[f"bits{i}"])) for i in range(SKETCH_BITS // 64)
    )
    differ = F.greatest(differ, F.abs(a["size"] - b["size"]))
    return differ * (1 + similarity) <= (a["size"] + b["size"]) * (1 - similarity) + 1e-6


def _parts(lines: list[str]) -> Iterator[list[str]]:
    """Consecutive lines of some SIGNED_AT_ONCE characters, so that arrays stay in the cache."""
    part, size = [], 0
    for line in lines:
        part.append(line)
        size += len(line)
        if size >= SIGNED_AT_ONCE:
            yield part
            part, size = [], 0
    if part:
        yield part


def _stretches(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, list[str]]]:
    """Hashes and texts of the distinct lines, not blank, of stretches of documents.

    A line that occurred in the task's latest stretches is left out; copies that remain do no harm.
    """
    known: set[int] = set()
    for batch in batches:
        held: dict[str, None] = {}
        size = 0
        for text in [*batch.column(0).to_pylist(), None]:
            if text is not None:
                lines = text.split("\n")
                held.update(dict.fromkeys(x for x in lines if x.strip(" \t\v\f\r")))
                size += len(text)
            if held and (text is None or size >= TEXT_AT_ONCE):
                named = {xxhash.xxh64_intdigest(x.encode(), SEED): x for x in held}
                held, size = {}, 0
                if len(known) >= REMEMBERED:
                    known.clear()
                for key in named.keys() & known:
                    del named[key]
                known.update(named)
                if named:
                    yield np.array(list(named), dtype=np.uint64).view(np.int64), list(named.values())


def _binaries(values: np.ndarray, starts: np.ndarray) -> pa.Array:
    """Consecutive numbers as binary values, each from one of the ``starts`` to the next."""
    offsets = (np.append(starts, len(values)) * 8).astype(np.int32)
    data = np.ascontiguousarray(values)
    return pa.Array.from_buffers(
        pa.binary(), len(starts), [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(data.tobytes())]
    )


def _banded(docs: DataFrame, text: str) -> DataFrame:
    """(bucket, bands, lines): the bands of the distinct lines of stretches of documents.

    A bucket is a range of bands. A row has those of one stretch, sorted, and the line of each.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for keys, lines in _stretches(batches):
            bands = np.concatenate([band_hashes(part) for part in _parts(lines)]).reshape(-1)
            order = np.argsort(bands)
            bands = bands[order]
            bucket = (bands >> np.uint64(64 - BUCKET_BITS)).astype(np.int32)
            starts = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1]))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(bucket[starts]),
                    _binaries(bands.view(np.int64), starts),
                    _binaries(keys[order // BANDS], starts),
                ],
                ["bucket", "bands", "lines"],
            )

    return docs.select(F.coalesce(F.col(text), F.lit(""))).mapInArrow(
        run, "bucket int, bands binary, lines binary"
    )


def _sketched(docs: DataFrame, text: str, among: Filter) -> DataFrame:
    """(line, sketch) of the lines that may be among those of a filter, each once."""
    names = ["size", *[f"bits{i}" for i in range(SKETCH_BITS // 64)]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for keys, lines in _stretches(batches):
            wanted = np.flatnonzero(among.holds(keys))
            sizes, bits = sketches([lines[i] for i in wanted.tolist()])
            columns = [keys[wanted], sizes.astype(np.int64), *bits.T]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.ascontiguousarray(x)) for x in columns], ["line", *names]
            )

    schema = ", ".join(f"{name} bigint" for name in ["line", *names])
    return (
        docs.select(F.coalesce(F.col(text), F.lit("")))
        .mapInArrow(run, schema)
        # Copies of a line have one sketch, so any of each number will do.
        .groupBy("line").agg(*[F.max(name).alias(name) for name in names])
        .select("line", F.struct(*names).alias("sketch"))
    )


def _shared(band: np.ndarray, line: np.ndarray, met: np.ndarray):
    """Of rows sorted by band: where bands start, whether others than the first line, the pivot, have been
    met, and the batch of rows of bands that several share. ``met`` says so of rows before these."""
    starts = np.flatnonzero(np.append(True, band[1:] != band[:-1]))
    pivot = np.repeat(line[starts], np.diff(np.append(starts, len(band))))
    shown = line != pivot
    several = np.add.reduceat(shown, starts) > 0
    # The pivot is shown once, with the first other line.
    shown[starts] = several & ~met[starts]
    found = pa.RecordBatch.from_arrays(
        [pa.array(x[shown]) for x in (band, line, pivot)], ["band", "line", "pivot"]
    )
    return starts, several | met[starts], found


MET_SCHEMA = "band bigint, line bigint, pivot bigint"


def _met(banded: DataFrame) -> DataFrame:
    """(band, line, pivot): the lines of bands that several share, with one of them, the pivot.

    Rows arrive sorted by band and pass by; of the last band only its pivot is kept. A line may
    come out more than once in a band.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # the last band, its pivot, whether other lines have been met
        for batch in batches:
            band, line = (column.to_numpy(zero_copy_only=False) for column in batch.columns)
            if not len(band):
                continue
            met = np.zeros(len(band) + (held is not None), dtype=bool)
            if held is not None:
                band, line = np.append(held[0], band), np.append(held[1], line)
                met[0] = held[2]
            starts, several, found = _shared(band, line, met)
            held = (band[-1], line[starts[-1]], several[-1])
            yield found

    return banded.mapInArrow(run, MET_SCHEMA)


def _met_in_buckets(banded: DataFrame) -> DataFrame:
    """The same of rows of ``_banded``, which arrive bucket by bucket.

    Of a bucket's rows that have passed by, each band's pivot is kept.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        none = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)
        last, kept, rows, size = None, none, [], 0

        def shared():
            band, line = (np.frombuffer(b"".join(x), np.int64) for x in zip(*rows, strict=True))
            band, line = np.append(kept[0], band), np.append(kept[1], line)
            met = np.append(kept[2], np.zeros(len(band) - len(kept[2]), dtype=bool))
            # Stable, which takes longer, only where there are pivots, which have to stay first.
            order = np.argsort(band, kind="stable" if len(kept[0]) else None)
            band, line = band[order], line[order]
            starts, several, found = _shared(band, line, met[order])
            return (band[starts], line[starts], several), found

        for batch in batches:
            for bucket, bands, lines in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if rows and (bucket != last or size >= BANDS_AT_ONCE):
                    kept, found = shared()
                    rows, size = [], 0
                    yield found
                if bucket != last:
                    last, kept = bucket, none
                rows.append((bands, lines))
                size += len(bands) // 8
        if rows:
            yield shared()[1]

    return banded.mapInArrow(run, MET_SCHEMA)


def _lines(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    return (
        docs.select(
            F.col(doc_id).cast("bigint").alias("doc_id"),
            row_key(doc_id, text).alias("row_key"),
            F.posexplode(F.split(text_or_empty(text), "\n")).alias("at", "words"),
        )
        .where(~F.col("words").rlike(BLANK))
        .withColumn("line", F.xxhash64("words"))
    )


def _filter_places(keys: np.ndarray, bits: int) -> list[np.ndarray]:
    mixed = _mixed(keys.view(np.uint64))
    return [mixed % np.uint64(bits), (mixed >> np.uint64(20)) * ODD[5] % np.uint64(bits)]


class Filter:
    """A Bloom filter of ``bits`` bits for the ``line`` column of ``keys``, whatever the data.

    Tasks put its words together to slabs of bytes, and the driver has a few hundred of these.
    """

    def __init__(self, keys: DataFrame, bits: int = FILTER_BITS):
        self.bits = bits

        def words(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                places = np.concatenate(_filter_places(batch["line"].to_numpy(), bits))
                yield pd.DataFrame(
                    {
                        "word": (places >> np.uint64(6)).astype(np.int64),
                        "bits": (np.uint64(1) << (places & np.uint64(63))).view(np.int64),
                    }
                )

        def slab(rows: pd.DataFrame) -> pd.DataFrame:
            word = rows["word"].to_numpy(np.int64)
            held = np.zeros(SLAB, dtype=np.int64)
            held[word % SLAB] = rows["bits"].to_numpy(np.int64)
            return pd.DataFrame({"slab": [word[0] // SLAB], "held": [held.tobytes()]})

        slabs = (
            keys.mapInPandas(words, "word bigint, bits bigint")
            .groupBy("word").agg(F.bit_or("bits").alias("bits"))
            .groupBy(F.expr(f"word div {SLAB}")).applyInPandas(slab, "slab bigint, held binary")
        )
        table = np.zeros(bits // 64, dtype=np.uint64)
        for row in slabs.collect():
            at = row["slab"] * SLAB
            table[at : at + SLAB] = np.frombuffer(row["held"], np.uint64)
        self.shared = keys.sparkSession.sparkContext.broadcast(table)

    def holds(self, lines: np.ndarray) -> np.ndarray:
        """Which of the lines may be among the keys."""
        yes = np.ones(len(lines), dtype=bool)
        for places in _filter_places(lines, self.bits):
            held = self.shared.value[(places >> np.uint64(6)).astype(np.int64)]
            yes &= (held >> (places & np.uint64(63))) & np.uint64(1) == 1
        return yes


def _words(docs: DataFrame, keys: DataFrame, text: str) -> DataFrame:
    """(line, words): the texts of the lines ``keys``, as a table."""
    among = Filter(keys)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for hashes, lines in _stretches(batches):
            wanted = np.flatnonzero(among.holds(hashes))
            found = pa.array([lines[i] for i in wanted.tolist()], pa.string())
            yield pa.RecordBatch.from_arrays([pa.array(hashes[wanted]), found], ["line", "words"])

    return saved(
        docs.select(F.coalesce(F.col(text), F.lit("")))
        .mapInArrow(run, "line bigint, words string")
        # Copies of a common line are one before they are shuffled.
        .groupBy("line").agg(F.min("words").alias("words"))
        .join(keys, "line", "left_semi"),
        "lines-words",
    )


def _verified(pairs: DataFrame, similarity: float) -> DataFrame:
    @F.pandas_udf("boolean")
    def similar(a: pd.Series, b: pd.Series) -> pd.Series:
        found = np.zeros(len(a), dtype=bool)
        # Pairs of one pivot lie together, so its shingles are numbered about once.
        order = np.argsort(pd.factorize(b)[0], kind="stable")
        for at in range(0, len(order), PAIRS_AT_ONCE):
            part = order[at : at + PAIRS_AT_ONCE]
            both = pd.concat([a.iloc[part], b.iloc[part]], ignore_index=True)
            numbers, lines = pd.factorize(both)
            shingled = Shingled(lines.tolist(), similarity)
            other, one = numbers[: len(part)], numbers[len(part) :]
            edges = np.flatnonzero(np.diff(one)) + 1
            for rows in np.split(np.arange(len(part)), edges):
                found[part[rows]] = shingled.near(one[rows[0]], other[rows])
        return pd.Series(found)

    return pairs.where(similar("words_a", "words_b"))


def _maybe_joined(similarity: float):
    """For the block pairs of some buckets: the rows whose sketch allows a line of another component
    to be near them. No other row can be in a link that joins components."""

    def kept(rows: pd.DataFrame) -> pd.DataFrame:
        key = ["band", "_one", "_two"]
        rows = rows.sort_values(key, kind="stable")
        # Unsigned: of a negative number, the bits of its absolute value would be counted.
        bits = np.stack([rows[f"bits{i}"].to_numpy(np.int64) for i in range(SKETCH_BITS // 64)]).view(np.uint64)
        sizes, parts = rows["size"].to_numpy(np.int64), rows["component"].to_numpy()
        values = rows[key].to_numpy()
        edges = np.flatnonzero((values[1:] != values[:-1]).any(axis=1)) + 1
        starts = np.concatenate([[0], edges])
        counts = np.diff(np.append(starts, len(rows)))
        keep = np.zeros(len(rows), dtype=bool)
        # Buckets of one number of rows are compared together, some COMPARED_AT_ONCE pairs of rows at a time.
        for n in np.unique(counts).tolist():
            of_size = starts[counts == n]
            step, rows_at_once = max(1, COMPARED_AT_ONCE // (n * n)), max(1, COMPARED_AT_ONCE // n)
            for at in range(0, len(of_size), step):
                all_ = of_size[at : at + step, None] + np.arange(n)
                for low in range(0, n, rows_at_once):
                    some = all_[:, low : low + rows_at_once]
                    one, two = some[:, :, None], all_[:, None, :]
                    differ = np.abs(sizes[one] - sizes[two])
                    bits_differ = np.bitwise_count(bits[:, one] ^ bits[:, two]).sum(axis=0, dtype=np.int64)
                    differ = np.maximum(differ, bits_differ)
                    allowed = (sizes[one] + sizes[two]) * (1 - similarity) + 1e-6
                    near = (differ * (1 + similarity) <= allowed) & (parts[one] != parts[two])
                    keep[some] = near.any(axis=2)
        return rows.loc[keep, ["band", "line", "component", "_one", "_two"]]

    return kept


def _joining(lines: np.ndarray, roots: np.ndarray, of: np.ndarray, shingled: Shingled):
    """Links between lines of different components, each joining two that were apart."""
    roots = roots.copy()
    left = len(np.unique(roots))
    for i in range(1, len(lines)):
        if left == 1:
            return
        apart = np.flatnonzero(roots[:i] != roots[i])
        if not len(apart):
            continue
        for j in apart[shingled.near(of[i], of[apart])].tolist():
            if roots[j] != roots[i]:
                roots[roots == roots[j]] = roots[i]
                left -= 1
                yield lines[i], lines[j]


def _links_across(similarity: float):
    """For the block pairs of some buckets: links that join their components, each once."""

    def links(rows: pd.DataFrame) -> pd.DataFrame:
        key = ["band", "_one", "_two"]
        rows = rows.sort_values([*key, "line"], kind="stable")
        line, parts = rows["line"].to_numpy(), rows["component"].to_numpy()
        number, first, of = np.unique(line, return_index=True, return_inverse=True)
        shingled = Shingled(rows["words"].iloc[first].tolist(), similarity)
        values = rows[key].to_numpy()
        edges = np.flatnonzero((values[1:] != values[:-1]).any(axis=1)) + 1
        found = []
        for a, b in zip([0, *edges.tolist()], [*edges.tolist(), len(rows)], strict=True):
            found += _joining(line[a:b], parts[a:b], of[a:b], shingled)
        return pd.DataFrame(found, columns=["a", "b"], dtype=np.int64)

    return links


def line_components(
    docs: DataFrame, *, similarity: float = SIMILARITY, text: str = "text", block: int = 512
) -> DataFrame:
    """(node, component) of the lines, by hash, that have a line of another text near them.

    Lines that share a band are candidates. First each bucket's lines are held against one
    of them, unless small sketches already prove them too different; then, in buckets that are not one component yet, members of
    different components against each other, in blocks of at most ``block`` lines, whose tasks
    pass on no more links than they join components.
    """
    buckets = _banded(docs, text).repartition("bucket").sortWithinPartitions("bucket")
    met = saved(_met_in_buckets(buckets), "lines-met")
    sketch = saved(_sketched(docs, text, Filter(met.select("line").distinct())), "lines-sketches")
    pairs = met.where("line <> pivot").select(F.col("line").alias("a"), F.col("pivot").alias("b"))
    # Sketches are smaller than texts, which are fetched for lines that may be near another alone.
    maybe = saved(
        pairs.distinct()
        .join(sketch.select(F.col("line").alias("a"), F.col("sketch").alias("sketch_a")), "a")
        .join(sketch.select(F.col("line").alias("b"), F.col("sketch").alias("sketch_b")), "b")
        .where(_maybe_similar(F.col("sketch_a"), F.col("sketch_b"), similarity))
        .select("a", "b"),
        "lines-maybe",
    )
    ends = maybe.select(F.explode(F.array("a", "b")).alias("line")).distinct()
    words = _words(docs, ends, text)
    texts = (
        maybe
        .join(words.select(F.col("line").alias("a"), F.col("words").alias("words_a")), "a")
        .join(words.select(F.col("line").alias("b"), F.col("words").alias("words_b")), "b")
    )
    stars = _verified(texts, similarity).select("a", "b")
    first = saved(connected_components(stars, "lines"), "lines-first")
    discard(maybe, words)

    labelled = saved(
        met.select("band", "line").distinct()
        .join(first.withColumnRenamed("node", "line"), "line", "left")
        .select("band", "line", F.coalesce("component", "line").alias("component")),
        "lines-labelled",
    )
    # Buckets of other bands with the same lines need no second look.
    mixed = (
        labelled.groupBy("band")
        .agg(
            F.count("*").alias("members"),
            F.sum(F.xxhash64("line").cast("decimal(20,0)")).alias("_lines"),
            F.min("component").alias("_low"),
            F.max("component").alias("_high"),
        )
        .where("members > 2 and _low <> _high")
        .groupBy("members", "_lines").agg(F.min("band").alias("band"))
        .select("band", "members")
    )
    mixed = saved(mixed, "lines-mixed")
    blocks = F.ceil(F.col("members") / block)
    rows = mixed.agg(F.sum(F.col("members") * blocks)).first()[0] or 0
    slot = F.pmod(F.xxhash64("band", "_one", "_two"), F.lit(rows // SLOT_ROWS + 1))
    close = (
        labelled.join(mixed, "band")
        .join(sketch, "line")
        .withColumn("_own", F.pmod(F.xxhash64("line", F.lit("block")), blocks))
        .withColumn("_other", F.explode(F.sequence(F.lit(0).cast("bigint"), blocks - 1)))
        .select(
            "band", "line", "component", "sketch.*",
            F.least("_own", "_other").alias("_one"), F.greatest("_own", "_other").alias("_two"),
        )
        .groupBy(slot.alias("_slot"))
        .applyInPandas(
            _maybe_joined(similarity),
            "band bigint, line bigint, component bigint, _one bigint, _two bigint",
        )
    )
    close = saved(close, "lines-close")
    # Lines of any length: as many slots as their characters ask for, too.
    sizes = close.join(sketch, "line").agg(F.count("*"), F.sum("sketch.size")).first()
    slots = (sizes[0] or 0) // SLOT_ROWS + (sizes[1] or 0) // SLOT_CHARACTERS + 1
    slot = F.pmod(F.xxhash64("band", "_one", "_two"), F.lit(slots))
    words = _words(docs, close.select("line").distinct(), text)
    more = (
        close.join(words, "line")
        .groupBy(slot.alias("_slot"))
        .applyInPandas(_links_across(similarity), "a bigint, b bigint")
    )
    more = saved(more, "lines-more")
    discard(met, sketch, words, labelled, mixed, close)
    if more.isEmpty():
        return first
    tree = first.select(F.col("node").alias("a"), F.col("component").alias("b"))
    linked = saved(connected_components(tree.unionByName(more), "lines"), "lines-all")
    discard(first, more)
    return linked


def repeated_lines(
    docs: DataFrame, *, similarity: float = SIMILARITY, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """(row_key, repeats): for documents with lines to remove, the places of these lines.

    Lines are near each other if the Jaccard similarity of their shingles, of four characters
    each, is ``similarity`` or more; a shorter line is one shingle. Of the lines that
    such links connect, the first stays: that of the least doc_id (null ids last), then of the
    least hash of the row, then the earliest in its text. Candidates are lines that agree in a
    band: at a similarity of exactly 0.8, 98.6 % of pairs do, the more similar the more.
    """
    with shuffles_removed(docs.sparkSession):
        components = line_components(docs, similarity=similarity, text=text)
        places = saved(_lines(docs, doc_id, text).drop("words"), "lines-places")
        named = (
            places.join(components.withColumnRenamed("node", "line"), "line", "left")
            .withColumn("component", F.coalesce("component", "line"))
            .withColumn("place", F.struct(F.col("doc_id").isNull().alias("n"), "doc_id", "row_key", "at"))
        )
        # A table of its own, so that the join on a common line's component can be split.
        first = saved(
            named.groupBy("component")
            .agg(F.min("place").alias("first"), F.max("place").alias("last"))
            .where("first <> last")
            .select("component", "first"),
            "lines-kept",
        )
    return (
        named.join(first, "component")
        .where("place <> first")
        .groupBy("row_key").agg(F.array_sort(F.collect_set("at")).alias("repeats"))
    )


def dedup_lines(docs: DataFrame, **options) -> DataFrame:
    """``docs`` with one line of each component of near-equal lines left, see ``repeated_lines``.

    Texts lose whole lines, their columns and other rows are kept. Blank lines are neither counted
    nor removed, a null text stays null, and a text that loses all its lines is empty. Rows that are
    equal in id and text are one document and come out alike, as often as they came in. An empty
    table gives an empty result; other columns are passed on.
    """
    doc_id, text = options.get("doc_id", "doc_id"), options.get("text", "text")
    key, places = unused("_row_key", docs), unused("_repeats", docs)
    repeats = repeated_lines(docs, **options).select(
        F.col("row_key").alias(key), F.col("repeats").alias(places)
    )
    kept = F.array_join(
        F.filter(
            F.split(F.col(text), "\n"),
            lambda line, at: ~F.array_contains(F.col(places), at),
        ),
        "\n",
    )
    cleaned = F.when(F.col(places).isNull(), F.col(text)).otherwise(kept)
    return (
        docs.withColumn(key, row_key(doc_id, text))
        .join(repeats, key, "left")
        .withColumn(text, cleaned)
        .drop(key, places)
    )


def op6_line_dedup(spark, sf_dir):
    """Per document: its lines that are not blank, how many stay, and the places of the others."""
    docs = documents(spark, sf_dir)
    lines = F.filter(F.split(text_or_empty("text"), "\n"), lambda x: ~x.rlike(BLANK))
    counts = docs.select(
        "doc_id", row_key("doc_id", "text").alias("row_key"), F.size(lines).alias("n_lines")
    )
    return counts.join(repeated_lines(docs), "row_key", "left").select(
        "doc_id",
        F.col("n_lines").cast("bigint").alias("n_lines"),
        (F.col("n_lines") - F.coalesce(F.size("repeats"), F.lit(0))).cast("bigint").alias("n_kept"),
        F.coalesce(F.array_join(F.col("repeats").cast("array<string>"), ","), F.lit("")).alias(
            "removed"
        ),
    )
