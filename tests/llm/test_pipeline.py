import hashlib
from collections import Counter

import public_tokenizers
import tiktoken
from pyspark.sql import functions as F
from tables import AWKWARD, SF_DIR, docs, given

import __spark_entry__ as entry
import corpus_pipeline
from anchorctx.llm.bpe import read_ranks


def test_stages_follow_each_other(spark):
    """Each stage takes whole documents, and what it decides holds for the next ones."""
    table = given(spark)
    columns, before = table.columns, table.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        found = stage(spark, table, str(SF_DIR))
        assert found.columns == columns and found.dtypes == table.dtypes
        table = spark.createDataFrame(found.collect(), table.schema)
        assert 0 < table.count() <= before, name
        before = table.count()
    tokens = {r.doc_id: r for r in corpus_pipeline.STAGES[-1][1](spark, table, str(SF_DIR)).collect()}
    ranks = read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    theirs = tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
    )
    texts = {r.doc_id: r.text for r in table.collect()}
    assert tokens.keys() == texts.keys()
    for d, t in texts.items():
        assert list(tokens[d].ids) == theirs.encode_ordinary(t or "")
        assert tokens[d].decoded_sha256 == hashlib.sha256((t or "").encode()).hexdigest()
    run = entry.queries()["pipeline"](spark, str(SF_DIR))
    assert {r.doc_id: r.ids_sha256 for r in run.collect()} == {
        d: r.ids_sha256 for d, r in tokens.items()
    }


def test_stages_take_empty_tables(spark):
    empty = docs(spark, []).select(*given(spark).columns)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, str(SF_DIR)).count() == 0


def test_stages_on_awkward_rows(spark):
    """Repeated rows, nulls, lines of megabytes, and columns of the names that stages use themselves."""
    long = " ".join(f"w{i}" for i in range(400_000))
    leak = given(spark, "benchmark").where("length(text) > 300").first().text
    rows = [*AWKWARD, (20, long), (21, long + " x"), (22, "Some words first.\n" + leak), (23, "\n" * 50)]
    table = docs(spark, rows).withColumns({n: F.lit("x") for n in ("_copy", "_repeats", "_row_key", "__row_key")})
    extra = [c for c in table.columns if c not in ("doc_id", "text", "lang", "source", "n_chars")]
    kept = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        found = stage(spark, table, str(SF_DIR))
        assert found.columns == table.columns and found.dtypes == table.dtypes
        got = found.collect()
        assert all(r[c] == "x" for r in got for c in extra), name
        kept[name] = Counter((r.doc_id, r.text) for r in got)
        table = spark.createDataFrame(got, table.schema)
    before = Counter(rows)
    assert kept["toxicity"] == before
    # Lines go, documents stay; the first of equal rows' lines stays in both.
    lines = kept["line dedup"]
    assert Counter(d for d, _ in lines.elements()) == Counter(d for d, _ in before.elements())
    assert lines[(1, None)] == 1 and lines[(20, long)] == 1 and lines[(21, "")] == 1
    assert lines[(5, "The same text twice, with the same id, for once and for all the others")] == 2
    assert lines[(6, "")] == 1
    # One of all that have no words, the least id; one of the repeated rows.
    near = kept["SimHash near-dedup"]
    assert [d for d, t in near if not (t or "").split()] == [1] and max(near.values()) == 1
    assert {d for d, _ in near} >= {1, 3, 5, 7, 8, 9, -3, 20, 22, None}
    clean = kept["benchmark decontamination"]
    assert near - clean == Counter({k: 1 for k in near if k[0] == 22})
    tokens = corpus_pipeline.encode(spark, table, str(SF_DIR)).collect()
    assert Counter(r.doc_id for r in tokens) == Counter(d for d, _ in clean.elements())
