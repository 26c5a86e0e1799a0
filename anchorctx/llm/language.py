"""Language identification by cross-parsing: how few phrases of a language a text is made of."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from anchorctx.llm.common import documents, held_out, prepare, saved

UNDECIDED = "und"
# What is learned from, at most: languages (those with the most rows), passages of each and
# the bytes that a language's passages have together.
LANGUAGES = 32
PASSAGE = 256
PASSAGES = 256
LEARNED_BYTES = 1 << 15
# Texts are parsed in blocks of so many bytes, so that a long one is parsed in many places at once.
BLOCK = 1 << 10
# Bytes of texts that are parsed together.
AT_ONCE = 1 << 21

_SPACE, _SEPARATOR = 32, 0
# Every byte that is no letter is a space, but bytes beyond ASCII are taken as they are.
_PLAIN = bytes(
    c if c >= 128 or 97 <= c <= 122 else c + 32 if 65 <= c <= 90 else _SPACE for c in range(256)
)


def plain_bytes(text: str) -> np.ndarray:
    """The UTF-8 bytes of a text in lower case, other marks than letters as single spaces."""
    found = np.frombuffer(text.lower().encode().translate(_PLAIN), np.uint8)
    keep = np.ones(len(found), bool)
    keep[1:] = (found[1:] != _SPACE) | (found[:-1] != _SPACE)
    return found[keep]


def suffix_automaton(body: bytes) -> list[dict[int, int]]:
    """Transitions of the least automaton of all substrings of ``body``; state 0 is its start.

    A path from the start spells a substring, so the longest match of a text with ``body`` ends
    where the path that it spells does. There are less than two states per byte.
    """
    following: list[dict[int, int]] = [{}]
    length, link = [0], [-1]
    last = 0
    for c in body:
        new = len(following)
        following.append({})
        length.append(length[last] + 1)
        link.append(0)
        state = last
        while state >= 0 and c not in following[state]:
            following[state][c] = new
            state = link[state]
        if state >= 0:
            target = following[state][c]
            if length[target] == length[state] + 1:
                link[new] = target
            else:
                # Substrings that end here and elsewhere part from the longer ones.
                copy = len(following)
                following.append(dict(following[target]))
                length.append(length[state] + 1)
                link.append(link[target])
                while state >= 0 and following[state].get(c) == target:
                    following[state][c] = copy
                    state = link[state]
                link[target] = link[new] = copy
        last = new
    return following


@dataclass(frozen=True)
class Languages:
    """The automata of all languages in one table, a row per state and a column per kind of byte.

    An entry is where the row of the next state starts. Row 0 is "no phrase begun": its entries
    are 0, as are those of missing transitions.
    """

    names: list[str]
    kind: np.ndarray
    table: np.ndarray
    first: np.ndarray
    weight: np.ndarray

    @classmethod
    def of(cls, learned: dict[str, bytes]) -> Languages:
        names = sorted(learned)
        used = sorted({c for body in learned.values() for c in body} - {_SEPARATOR})
        # The last kind stands for bytes that no language has.
        width = len(used) + 1
        kind = np.full(256, width - 1, np.uint8)
        kind[used] = np.arange(len(used))
        rows, offset = [np.zeros((1, width), np.uint32)], 1
        first = np.zeros((len(names), width), np.uint32)
        for number, name in enumerate(names):
            automaton = suffix_automaton(learned[name])
            own = np.zeros((len(automaton), width), np.uint32)
            for state, following in enumerate(automaton):
                for c, target in following.items():
                    if c != _SEPARATOR:
                        own[state, kind[c]] = (offset + target) * width
            first[number] = own[0]
            rows.append(own)
            offset += len(automaton)
        bits = np.log2([max(2, len(learned[name])) for name in names])
        return cls(names, kind, np.concatenate(rows).ravel(), first, np.array(bits))

    def phrases(self, bodies: list[np.ndarray]) -> np.ndarray:
        """How many phrases each body has in each language: an array of bodies × languages.

        A phrase is the longest match of what follows with the language's text, or a
        byte that it does not have; it ends where a block of the body does. All blocks and languages
        are walked at once, byte by byte.
        """
        blocks = [(of, body[at : at + BLOCK]) for of, body in enumerate(bodies) for at in range(0, len(body), BLOCK)]
        blocks.sort(key=lambda block: -len(block[1]))
        of = np.array([number for number, _ in blocks], np.int64)
        sizes = np.array([len(part) for _, part in blocks], np.int64)
        begins = np.cumsum(sizes) - sizes
        kinds = self.kind[np.concatenate([part for _, part in blocks])] if blocks else None
        state = np.zeros((len(self.names), len(blocks)), np.uint32)
        count = np.zeros(state.shape, np.int32)
        for step in range(sizes.max(initial=0)):
            # Blocks still going come first, as they are in order of size.
            going = np.searchsorted(-sizes, -step, side="left")
            kind = kinds[begins[:going] + step]
            after = self.table[state[:, :going] + kind]
            ended = after == 0
            count[:, :going] += ended
            state[:, :going] = np.where(ended, self.first[:, kind], after)
        total = np.zeros((len(bodies), len(self.names)), np.int64)
        np.add.at(total, of, count.T)
        return total

    def identify(self, texts: list[str]) -> tuple[list[str], list[float]]:
        """The language of the least cost for each text, and by what share the next one costs more.

        The cost is the cross-entropy: phrases, each worth the bits that name a place in the
        language's text. Equal costs go to the name that sorts first.
        """
        if not self.names:
            return [UNDECIDED] * len(texts), [0.0] * len(texts)
        cost = self.phrases([plain_bytes(text) for text in texts]) * self.weight
        best = cost.argmin(axis=1)
        ordered = np.sort(cost, axis=1)
        least = ordered[:, 0]
        second = ordered[:, 1] if len(self.names) > 1 else np.full(len(texts), np.inf)
        score = np.where(second > 0, 1 - least / np.where(second > 0, second, 1), 0.0)
        return [self.names[i] for i in best], score.tolist()


def learned_passages(
    docs: DataFrame, mod: int, remainder: int, doc_id: str, text: str, lang: str
) -> DataFrame:
    """(lang, passage): passages of the texts that are learned from, drawn by a hash.

    Texts are cut into passages throughout, and equal passages count once. A share of
    them that follows from their number is taken, some two times PASSAGES of a language,
    or all where there are fewer.
    """
    known = docs.where(~held_out(doc_id, mod, remainder)).select(
        F.col(lang).cast("string").alias("lang"), F.col(text).alias("text")
    ).where("lang is not null and text rlike '\\\\p{L}'")
    pieces = (
        known.select(
            "lang",
            F.explode(F.regexp_extract_all("text", F.lit(f"(?s).{{1,{PASSAGE}}}"), F.lit(0))).alias("passage"),
        )
        .where(r"passage rlike '\\p{L}'")
        .withColumn("hash", F.xxhash64("passage"))
    )
    numbers = saved(
        pieces.groupBy("lang")
        .agg(F.approx_count_distinct("hash").alias("passages"), F.count("*").alias("rows"))
        .orderBy(F.desc("rows"), "lang").limit(LANGUAGES),
        "language-numbers",
    )
    # LANGUAGES rows. A hash over 2 ** 64, plus a half, lies evenly between 0 and 1.
    drawn = pieces.join(F.broadcast(numbers), "lang").where(
        f"hash / 1.8446744073709552E19D + 0.5 < {2 * PASSAGES} / passages"
    )
    return drawn.select("lang", "hash", "passage").distinct()


def learn_languages(docs: DataFrame, mod: int, remainder: int, *, doc_id="doc_id", text="text", lang="lang") -> Languages:
    """The languages of the rows that are not held out; see LANGUAGES, PASSAGES and LEARNED_BYTES."""

    def joined(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["hash", "passage"]).head(PASSAGES)
        body = bytes([_SEPARATOR]).join(plain_bytes(p).tobytes() for p in rows["passage"])
        return pd.DataFrame({"lang": rows["lang"].iloc[:1], "body": [body[:LEARNED_BYTES]]})

    passages = learned_passages(docs, mod, remainder, doc_id, text, lang)
    bodies = passages.groupBy("lang").applyInPandas(joined, "lang string, body binary")
    return Languages.of({row["lang"]: bytes(row["body"]) for row in bodies.collect()})


def _parts(texts: list[str]) -> Iterator[tuple[int, int]]:
    """Stretches of rows that have some AT_ONCE characters."""
    start, size = 0, 0
    for end, text in enumerate(texts, 1):
        size += len(text)
        if size >= AT_ONCE:
            yield start, end
            start, size = end, 0
    if start < len(texts):
        yield start, len(texts)


def identify_languages(
    docs: DataFrame,
    *,
    mod: int = 4,
    remainder: int = 2,
    doc_id: str = "doc_id",
    text: str = "text",
    lang: str = "lang",
) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) of every row of ``docs``.

    Learns from rows with a language whose crc32(doc_id as text) mod ``mod`` is not ``remainder``: for each of
    at most LANGUAGES languages a suffix automaton of at most LEARNED_BYTES bytes of passages drawn from the whole
    texts. A text is parsed into the longest phrases that occur there; the language with the least cross-entropy,
    phrases times the logarithm of the learned length, wins. ``score`` is by what share its cost is below
    the next language's: 0 is a draw, and it is 1 if only one language was learned.

    A text that is null or has no letter is ``und`` with score 0, and so is any text if nothing was learned. Whole
    texts are parsed, in blocks of BLOCK bytes at which phrases end. Null ids are never held out, equal
    rows are predicted alike and come out as often as they came in, an empty table gives an empty result, and
    other columns are not read. The automata are broadcast: at most LANGUAGES tables of 2 × LEARNED_BYTES
    states, 4 bytes for each kind of byte that occurs.
    """
    spark = docs.sparkSession
    prepare(spark)
    shared = spark.sparkContext.broadcast(
        learn_languages(docs, mod, remainder, doc_id=doc_id, text=text, lang=lang)
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        languages = shared.value
        for batch in batches:
            texts = batch.column(2).to_pylist()
            for start, end in _parts([t or "" for t in texts]):
                part = texts[start:end]
                lettered = [i for i, t in enumerate(part) if t is not None]
                names, scores = [UNDECIDED] * len(part), [0.0] * len(part)
                for i, name, score in zip(
                    lettered, *languages.identify([part[i] for i in lettered]), strict=True
                ):
                    names[i], scores[i] = name, score
                own = batch.slice(start, end - start)
                yield pa.RecordBatch.from_arrays(
                    [own.column(0), own.column(1), pa.array(names), pa.array(scores, pa.float64())],
                    ["doc_id", "held_out", "lang_pred", "score"],
                )

    rows = docs.select(
        F.col(doc_id).cast("bigint").alias("doc_id"),
        held_out(doc_id, mod, remainder).alias("held_out"),
        # Null where there is no letter, in any script.
        F.when(F.col(text).rlike(r"\p{L}"), F.col(text)).alias("text"),
    )
    return rows.mapInArrow(run, "doc_id bigint, held_out boolean, lang_pred string, score double")


def op13_language(spark, sf_dir):
    return identify_languages(documents(spark, sf_dir))
