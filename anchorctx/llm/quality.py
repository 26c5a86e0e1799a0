"""Quality classifier: a sparse ensemble of rules, compiled to a column expression."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from anchorctx.llm.common import documents, held_out, saved
from anchorctx.llm.training import byte_shares, labelled_sample, with_statistics

# Labelled rows learned from, at most.
LABELLED_ROWS = 20_000
TREES, DEPTH = 24, 3
LASSO = 0.002
SEED = 17

STATISTICS = [
    "letters", "upper", "digits", "space", "stops", "shouts", "symbols",
    "words", "word_length", "longest_word", "distinct_words", "distinct_pairs", "commonest_word",
    "no_letter_words", "marked_words", "short_words", "lines", "line_words", "repeated_lines",
    "short_lines",
]


def statistics(body: bytes) -> list[float]:
    """The STATISTICS of one text."""
    shares = byte_shares(body)
    words = body.split()
    n = max(1, len(words))
    lengths = [len(w) for w in words]
    counts: dict[bytes, int] = {}
    for w in words:
        counts[w] = counts.get(w, 0) + 1
    lines = [line for line in body.split(b"\n") if line.strip()]
    m = max(1, len(lines))
    return [
        *shares.values(),
        math.log1p(len(words)),
        sum(lengths) / n,
        max(lengths, default=0),
        len(counts) / n,
        len(set(zip(words, words[1:], strict=False))) / max(1, len(words) - 1),
        max(counts.values(), default=0) / n,
        sum(c for w, c in counts.items() if not w.strip(b"0123456789!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~")) / n,
        sum(c for w, c in counts.items() if w[-1] in b"#$%&*|!@^~=+_<>") / n,
        sum(1 for x in lengths if x <= 3) / n,
        math.log1p(len(lines)),
        len(words) / m,
        1 - len(set(lines)) / m,
        sum(1 for line in lines if len(line) < 40) / m,
    ]


@dataclass(frozen=True)
class Rule:
    """A conjunction of conditions (statistic, above, threshold)."""

    conditions: frozenset[tuple[str, bool, float]]

    def column(self) -> Column:
        found = F.lit(True)
        for name, above, threshold in sorted(self.conditions):
            found = found & (F.col(name) > threshold if above else F.col(name) <= threshold)
        return found.cast("double")


def tree_rules(node, names: list[str], path: dict | None = None) -> set[Rule]:
    """The paths to all nodes below the root of a fitted tree, each as one rule."""
    path = path or {}
    found = {Rule(frozenset((n, up, t) for (n, up), t in path.items()))} if path else set()
    if "Leaf" in node.getClass().getSimpleName():
        return found
    name, threshold = names[node.split().featureIndex()], node.split().threshold()
    for child, above in ((node.leftChild(), False), (node.rightChild(), True)):
        # Of several bounds on the same side the narrowest counts.
        bounds = [threshold, path.get((name, above), threshold)]
        narrower = max(bounds) if above else min(bounds)
        found |= tree_rules(child, names, {**path, (name, above): narrower})
    return found


@dataclass(frozen=True)
class RuleEnsemble:
    """Weights of rules in a logistic score."""

    intercept: float
    rules: tuple[tuple[Rule, float], ...]

    def column(self) -> Column:
        total = F.lit(self.intercept)
        for rule, weight in self.rules:
            total = total + rule.column() * weight
        return 1 / (1 + F.exp(-total))


def fit_rules(rows: DataFrame, names: list[str], lasso: float = LASSO) -> RuleEnsemble:
    """Rules from the paths of a forest's trees, weighted by logistic regression with an L1 penalty.

    ``rows`` has a ``label`` of 0 or 1 and the named statistics. Rows of one label only,
    or none, give a constant score.
    """
    counts = {label: n for label, n in rows.groupBy("label").count().collect()}
    good, total = counts.get(1.0, 0), sum(counts.values())
    prior = math.log((good + 0.5) / (total - good + 0.5))
    if good in (0, total):
        return RuleEnsemble(prior, ())
    assembled = VectorAssembler(inputCols=names, outputCol="features").transform(rows)
    forest = RandomForestClassifier(
        numTrees=TREES, maxDepth=DEPTH, minInstancesPerNode=5, subsamplingRate=0.7,
        featureSubsetStrategy="0.5", seed=SEED,
    ).fit(assembled)
    rules: set[Rule] = set()
    for tree in forest.trees:
        rules |= tree_rules(tree._java_obj.rootNode(), names)
    ordered = sorted(rules, key=lambda rule: sorted(rule.conditions))
    if not ordered:
        return RuleEnsemble(prior, ())
    columns = [rule.column().alias(f"r{i}") for i, rule in enumerate(ordered)]
    held = VectorAssembler(
        inputCols=[f"r{i}" for i in range(len(ordered))], outputCol="features"
    ).transform(rows.select("label", *columns))
    model = LogisticRegression(
        regParam=lasso, elasticNetParam=1.0, standardization=False, maxIter=60
    ).fit(held.select("label", "features"))
    weighted = zip(ordered, model.coefficients.toArray().tolist(), strict=True)
    return RuleEnsemble(model.intercept, tuple((rule, w) for rule, w in weighted if w))


def score_quality(
    docs: DataFrame,
    labels: DataFrame,
    *,
    label: str = "quality",
    mod: int = 5,
    remainder: int = 0,
    threshold: float = 0.3,
    labelled_rows: int = LABELLED_ROWS,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row of ``docs``.

    Learns from at most ``labelled_rows`` labelled documents whose crc32(doc_id as text) mod
    ``mod`` is not ``remainder``, by statistics of the texts alone. The fitted rules are one
    column expression over these.

    A null text counts as empty and is scored like any other; null ids are never held out nor
    learned from; repeated rows come out as often as they came in; an empty table gives an empty
    result. Other columns are not read.
    """
    rows = saved(with_statistics(docs, STATISTICS, statistics, doc_id=doc_id, text=text), "quality")
    sample = labelled_sample(labels, label, mod, remainder, labelled_rows)
    # The sample's size is bounded.
    known = saved(rows.join(F.broadcast(sample), "doc_id"), "quality-known").coalesce(8)
    ensemble = fit_rules(known, STATISTICS)
    return rows.select(
        "doc_id",
        held_out("doc_id", mod, remainder).alias("held_out"),
        ensemble.column().alias("score"),
    ).withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def op3_quality(spark, sf_dir):
    return score_quality(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))
