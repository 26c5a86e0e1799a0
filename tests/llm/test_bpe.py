import hashlib
import random

import pytest
import public_tokenizers
import tiktoken
from tables import AWKWARD, docs, given

import __spark_entry__ as entry
from anchorctx.llm.bpe import Encoder, Merger, decode_column, encode_documents, merge, pair_table, read_ranks
from tables import SF_DIR

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")
RANKS = read_ranks(PATH)
PAIRS = pair_table(RANKS)
THEIRS = tiktoken.Encoding(
    "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=RANKS, special_tokens={}
)


def measured(spark, table):
    encoded = encode_documents(table, PATH)
    rows = encoded.select("doc_id", "ids", decode_column(table, PATH)).collect()
    return sorted(((r[0], list(r[1]), bytes(r[2])) for r in rows), key=str)


def expected(rows):
    return sorted(
        ((d, THEIRS.encode_ordinary(t or ""), (t or "").encode()) for d, t in rows), key=str
    )


def test_given_documents(spark):
    table = given(spark)
    assert measured(spark, table) == expected([(r.doc_id, r.text) for r in table.collect()])


def test_awkward_rows(spark):
    rows = [*AWKWARD, (20, "<|endoftext|> is plain"), (21, "　  \n\n  tail  ")]
    assert measured(spark, docs(spark, rows)) == expected(rows)
    assert measured(spark, docs(spark, [])) == []


def encoder():
    return Encoder(RANKS, PAIRS, public_tokenizers.PATTERN)


@pytest.mark.parametrize("seed", range(5))
def test_random_pieces(seed):
    """One by one and many at once."""
    choices = random.Random(seed)
    pieces = ["".join(choices.choices("abeinrst éß漢 \t0!", k=choices.randint(1, 40))) for _ in range(300)]
    wanted = [THEIRS.encode_ordinary(p) for p in pieces]
    assert encoder().encode(pieces) == wanted
    assert [encoder().encode([p])[0] for p in pieces[:20]] == wanted[:20]
    single = [p.encode()[: choices.randint(1, 90)] for p in pieces]
    assert Merger(RANKS, PAIRS)(single) == [merge(p, RANKS) for p in single]


@pytest.mark.parametrize("seed", range(5))
def test_random_white_space(seed):
    choices = random.Random(seed)
    parts = ["a", "the", "'s", "1", "!?", "é", " ", "  ", "\n", " \n", "\u3000", "\xa0", "\x1c", "\x85", "\t"]
    texts = ["".join(choices.choices(parts, k=choices.randint(0, 12))) for _ in range(2000)]
    assert encoder().encode(texts) == [THEIRS.encode_ordinary(t) for t in texts]


def test_a_very_long_piece():
    piece = b"ab" * 20_000
    assert b"".join(THEIRS.decode_single_token_bytes(i) for i in merge(piece, RANKS)) == piece
    assert merge(piece, RANKS) == THEIRS.encode_ordinary(piece.decode())


def test_memory_is_bounded(monkeypatch):
    import anchorctx.llm.bpe as module

    monkeypatch.setattr(module, "REMEMBERED", 10)
    monkeypatch.setattr(module, "TEXT_AT_ONCE", 40)
    texts = [f"word{i} of {'x' * 70}{i}" for i in range(100)]
    own, ids = encoder(), []
    for part in module._stretches(texts):
        ids += own.encode(part)
        assert len(own.known) <= 10 + 8 * len(part)
    assert ids == [THEIRS.encode_ordinary(t) for t in texts]


def test_query(spark):
    found = entry.queries()["op8_bpe"](spark, str(SF_DIR)).collect()
    texts = {r.doc_id: r.text for r in given(spark).collect()}
    assert len(found) == len(texts)
    for r in found:
        ids = THEIRS.encode_ordinary(texts[r.doc_id])
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()
