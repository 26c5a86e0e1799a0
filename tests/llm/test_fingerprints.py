import hashlib
import re

import xxhash
from tables import AWKWARD, docs, given

from anchorctx.llm.fingerprints import as_text, containment, fingerprint_documents

LIMIT = -(1 << 63) + (1 << 64) // 8


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def chained(words):
    seed = 42
    for w in words:
        seed = xxhash.xxh64_intdigest(w.encode(), seed)
    return signed(seed)


def sketch(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    hashes = {chained(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()
    kept = {h for h in hashes if h < LIMIT}
    return sorted(kept or ({min(hashes)} if hashes else set()))


def share(a, b):
    if not a:
        return 0.0 if b else 1.0
    return len(set(a) & set(b)) / len(a)


def written(s):
    return "".join(f"{h & (1 << 64) - 1:016x}" for h in s)


def key(spark, rows):
    """The order of documents of one id: by the hash of the row."""
    from anchorctx.llm.common import row_key, text_or_empty

    table = docs(spark, rows).withColumn("text", text_or_empty("text"))
    return {(r[0], r[1]): r[2] for r in table.select("doc_id", "text", row_key("doc_id", "text")).collect()}


def expected(spark, rows):
    keys = key(spark, rows)
    order = sorted(keys, key=lambda x: (x[0] is None, -(x[0] or 0), keys[x]))
    following = dict(zip(order, order[1:] + order[:1], strict=True))
    found = []
    for d, t in rows:
        t = t or ""
        other = following[d, t][1]
        n = len(t) // 3
        edited = t[: len(t) - n] + other[:n]
        s, e = sketch(t), sketch(edited)
        found.append(
            (d, len(t), hashlib.sha256(edited.encode()).hexdigest(), written(s), written(e),
             share(s, e), share(s, sketch(other)), following[d, t][0])
        )
    return sorted(found, key=str)


def measured(table):
    from pyspark.sql import functions as F

    found = fingerprint_documents(table).select(
        "doc_id", "n_chars", F.sha2("edited", 256), as_text("sketch"), as_text("edited_sketch"),
        containment("sketch", "edited_sketch"), containment("sketch", "next_sketch"), "next_doc_id",
    )
    return sorted((tuple(r) for r in found.collect()), key=str)


def test_given_documents(spark):
    table = given(spark)
    rows = [(r.doc_id, r.text) for r in table.collect()]
    assert measured(table) == expected(spark, rows)


def test_awkward_rows(spark):
    assert measured(docs(spark, AWKWARD)) == expected(spark, AWKWARD)


def test_one_document_and_none(spark):
    assert measured(docs(spark, [(1, "only this one")])) == expected(spark, [(1, "only this one")])
    assert measured(docs(spark, [])) == []


def test_no_python_on_the_executors(spark):
    plan = fingerprint_documents(given(spark))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan
