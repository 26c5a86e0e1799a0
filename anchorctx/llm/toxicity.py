"""Toxicity: boosted trees over dense features, with isotonic calibration."""

from __future__ import annotations

import math
import re

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from anchorctx.llm.common import documents, held_out, saved, without_keys
from anchorctx.llm.training import byte_shares, labelled_sample, with_statistics

# Labelled rows learned from, at most; a part of them calibrates.
LABELLED_ROWS = 20_000
CALIBRATED_PART = 0.3
TREES, DEPTH = 20, 3
SEED = 17
# Words of the lexicon that labels teach, at most; each in this share of toxic texts, at least.
LEARNED_WORDS = 100
LEAST_SHARE = 0.02
NEAR = 6

# Insults that count whether or not the labels show them.
INSULTS = """
    idiot moron stupid loser scum trash worthless pathetic disgusting clown dumb fool imbecile
    idiota estúpido imbécil basura asqueroso inútil payaso
    dumm idiotisch abschaum müll wertlos widerlich trottel
    stupide crétin ordure minable dégoûtant débile
""".split()
# Words for the one who is spoken to.
SECOND_PERSON = {
    w.encode()
    for w in """
    you your yours you're youre u ur tú tu te ti usted ustedes du dich dir dein deine euch ihr
    vous toi ton ta votre vos
""".split()
}
# Characters that stand for letters; 1 stands for two of them.
LOOK_ALIKE = [bytes.maketrans(b"01345@$!|", letters) for letters in (b"oieasasil", b"oleasasil")]
EDGES = b".,;:!?\"'()[]{}<>*_-#$%&@~|/\\"
INNER = re.compile(rb"[.*_\-~+^#'`]+")

FEATURES = [
    "letters", "upper", "digits", "space", "stops", "shouts", "symbols",
    "words", "lexicon", "lexicon_distinct", "lexicon_weight", "fixed_lexicon", "near_second_person",
    "second_person", "capital_words", "capital_lexicon", "obfuscated", "obfuscated_lexicon",
    "runs_of_stops",
]
RUNS = re.compile(rb"[!?]{2,}")


def plain_words(body: bytes) -> list[bytes]:
    """Words in lower case, without the marks around them."""
    return [w.strip(EDGES) for w in body.lower().split()]


def feature_function(weights: dict[bytes, float]):
    """The FEATURES of a text by a lexicon of weights."""
    fixed = {w.encode() for w in INSULTS}
    lexicon = {**dict.fromkeys(fixed, 1.0), **weights}

    def features(body: bytes) -> list[float]:
        shares = byte_shares(body)
        words = body.split()
        n = max(1, len(words))
        plain = plain_words(body)
        found = [i for i, w in enumerate(plain) if w in lexicon]
        second = [i for i, w in enumerate(plain) if w in SECOND_PERSON]
        near, at = 0, 0
        for i in found:
            while at < len(second) and second[at] < i - NEAR:
                at += 1
            near += at < len(second) and second[at] <= i + NEAR
        # Letters beside digits or marks inside a word, and what they may stand for.
        odd = [
            w for w in plain if w and not w.isalpha() and w.isascii() and any(97 <= c <= 122 for c in w)
        ]
        hidden = sum(
            any(INNER.sub(b"", x) in lexicon for x in (w, *map(w.translate, LOOK_ALIKE)))
            for w in odd
        )
        return [
            *shares.values(),
            math.log1p(len(words)),
            len(found) / n,
            len({plain[i] for i in found}),
            sum(lexicon[plain[i]] for i in found) / n,
            sum(plain[i] in fixed for i in found) / n,
            near / n,
            len(second) / n,
            sum(1 for w in words if len(w) > 1 and w.isupper()) / n,
            sum(1 for i in found if words[i].isupper()) / n,
            len(odd) / n,
            hidden / n,
            len(RUNS.findall(body)) / n,
        ]

    return features


def learned_lexicon(texts: DataFrame, text: str, label: str) -> dict[bytes, float]:
    """Words that tell labelled texts apart, with the logarithm of their odds; a bounded number."""

    @F.pandas_udf("array<binary>")
    def words(bodies):
        return bodies.map(lambda body: list(set(plain_words(bytes(body or b""))) - {b""}))

    counts = dict(texts.groupBy(label).count().collect())
    bad, good = counts.get(1.0, 0), counts.get(0.0, 0)
    scored = (
        texts.select(label, F.explode(words(F.col(text).cast("binary"))).alias("word"))
        .groupBy("word").agg(F.sum(label).alias("bad"), F.count("*").alias("n"))
        .where(F.col("bad") >= max(3.0, LEAST_SHARE * bad))
        .withColumn(
            "odds",
            F.log((F.col("bad") + 0.5) / (bad + 1)) - F.log((F.col("n") - F.col("bad") + 0.5) / (good + 1)),
        )
        .where("odds > 2")
        .orderBy(F.desc(F.col("odds") * F.sqrt("bad")), "word").limit(LEARNED_WORDS)
    )
    return {bytes(row["word"]): row["odds"] for row in scored.select("word", "odds").collect()}


def score_toxicity(
    docs: DataFrame,
    labels: DataFrame,
    *,
    label: str = "toxic",
    mod: int = 3,
    remainder: int = 1,
    threshold: float = 0.7,
    labelled_rows: int = LABELLED_ROWS,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """(doc_id, row_key, held_out, score, predicted) for every row of ``docs``.

    Learns from at most ``labelled_rows`` labelled documents whose crc32(doc_id as text) mod
    ``mod`` is not ``remainder``. The lexicon has fixed insults and words that the labels show.
    Trees boosted on most of the sample give a margin, and isotonic regression on the rest of it
    a probability. Rows of one label only, or none, give every text the same score.

    A null text counts as empty and is scored like any other; null ids are never held out nor
    learned from; repeated rows come out as often as they came in; an empty table gives an empty
    result. Other columns are not read.
    """
    sample = labelled_sample(labels, label, mod, remainder, labelled_rows)
    part = F.pmod(F.xxhash64("doc_id", F.lit("calibrate")), F.lit(1000)) < int(1000 * CALIBRATED_PART)
    sample = sample.withColumn("calibrates", part)
    # The sample's size is bounded.
    texts = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    texts = texts.join(F.broadcast(sample), "doc_id").where(~F.col("calibrates"))
    weights = learned_lexicon(texts, "text", "label")
    rows = saved(
        with_statistics(docs, FEATURES, feature_function(weights), doc_id=doc_id, text=text),
        "toxicity",
    )
    known = saved(rows.join(F.broadcast(sample), "doc_id"), "toxicity-known").coalesce(8)
    score = _fitted(known)
    return (
        score(rows.withColumn("held_out", held_out("doc_id", mod, remainder)))
        .select("doc_id", "row_key", "held_out", "score")
        .withColumn("predicted", (F.col("score") >= threshold).cast("int"))
    )


def _fitted(known: DataFrame):
    """A function that adds ``score`` to rows with FEATURES."""
    counts: dict[tuple, int] = {
        (row["calibrates"], row["label"]): row["count"]
        for row in known.groupBy("calibrates", "label").count().collect()
    }
    total = sum(counts.values())
    bad = sum(n for (_, x), n in counts.items() if x == 1.0)
    if any(not counts.get((c, x)) for c in (True, False) for x in (0.0, 1.0)):
        share = (bad + 0.5) / (total + 1.0)
        return lambda rows: rows.withColumn("score", F.lit(share))
    assembler = VectorAssembler(inputCols=FEATURES, outputCol="features")
    learned = assembler.transform(known).select("label", "features", "calibrates")
    trees = GBTClassifier(
        maxIter=TREES, maxDepth=DEPTH, stepSize=0.2, minInstancesPerNode=5, seed=SEED
    ).fit(learned.where("not calibrates"))

    def margin(rows: DataFrame) -> DataFrame:
        found = trees.transform(rows)
        return found.withColumn("margin", vector_to_array("probability")[1])

    isotonic = IsotonicRegression(featuresCol="margin", labelCol="label", predictionCol="score")
    calibrated = isotonic.fit(margin(learned.where("calibrates")).select("label", "margin"))
    return lambda rows: calibrated.transform(
        margin(assembler.transform(rows)).drop("prediction", "rawPrediction", "probability")
    )


def without_toxic(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """``docs`` without the rows that ``score_toxicity`` predicts to be toxic.

    All columns are kept as they are, whatever their names. Rows equal in id and text stay or go
    together, null and empty texts are scored as empty ones, null ids are ids like any other. Where the
    labels are of one kind or missing, all texts have one score, and an empty table gives an empty one.
    """
    toxic = score_toxicity(docs, labels, **options).where("predicted = 1")
    return without_keys(docs, toxic, options.get("doc_id", "doc_id"), options.get("text", "text"))


def op7_toxicity(spark, sf_dir):
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return score_toxicity(documents(spark, sf_dir), labels).drop("row_key")
