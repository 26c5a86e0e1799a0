"""Fitted trees, rules and calibration worked out again by plain loops."""

import math
import re

import pytest
from tables import docs
from test_classifiers import SF, labels, texts

from anchorctx.llm import quality, toxicity

CONDITION = re.compile(r"(?:If|Else) \(feature (\d+) (<=|>) ([^)]+)\)")


def grown(tree):
    """A fitted tree from its printed form: (feature, threshold, low, high), or a leaf's prediction."""
    lines = iter(tree.toDebugString.splitlines()[1:])

    def node():
        line = next(lines).strip()
        if line.startswith("Predict"):
            return float(line.split(":")[1])
        feature, sign, threshold = CONDITION.fullmatch(line).groups()
        assert sign == "<="
        low = node()
        assert CONDITION.fullmatch(next(lines).strip()).groups() == (feature, ">", threshold)
        return int(feature), float(threshold), low, node()

    return node()


def walked(node, values):
    """The leaf's prediction, and the conditions met on the way to it, after each step."""
    met, steps = {}, []
    while isinstance(node, tuple):
        feature, threshold, low, high = node
        above = values[feature] > threshold
        old = met.get((feature, above), threshold)
        met[feature, above] = max(old, threshold) if above else min(old, threshold)
        steps.append(frozenset((f, up, t) for (f, up), t in met.items()))
        node = high if above else low
    return node, steps


def fitted(monkeypatch, estimator):
    """The models that an estimator fits from now on."""
    found, fit = [], estimator.fit

    def kept(self, *args):
        found.append(fit(self, *args))
        return found[-1]

    monkeypatch.setattr(estimator, "fit", kept)
    return found


def test_rules_are_the_paths_of_the_forest(spark, monkeypatch):
    forests = fitted(monkeypatch, quality.RandomForestClassifier)
    rows, marks = texts(300)
    stats = quality.with_statistics(docs(spark, rows), quality.STATISTICS, quality.statistics)
    known = stats.join(labels(spark, marks).select("doc_id", "quality"), "doc_id")
    quality.fit_rules(known.selectExpr("*", "cast(quality as double) as label"), quality.STATISTICS)
    values = [[r[name] for name in quality.STATISTICS] for r in stats.collect()]
    number = {name: i for i, name in enumerate(quality.STATISTICS)}
    for tree in forests[0].trees:
        rules = {
            frozenset((number[n], up, t) for n, up, t in rule.conditions)
            for rule in quality.tree_rules(tree._java_obj.rootNode(), quality.STATISTICS)
        }
        root, passed = grown(tree), set()
        for row in values:
            steps = set(walked(root, row)[1])
            true = {r for r in rules if all((row[f] > t) == up for f, up, t in r)}
            assert true == steps
            passed |= steps
        # Trees may have learned from samples that reach nodes which no row here reaches, none else.
        assert passed <= rules


def test_toxicity_from_trees_and_steps_by_loops(spark, monkeypatch):
    boosted = fitted(monkeypatch, toxicity.GBTClassifier)
    calibrated = fitted(monkeypatch, toxicity.IsotonicRegression)
    lexicons, learned = [], toxicity.learned_lexicon
    monkeypatch.setattr(
        toxicity, "learned_lexicon", lambda *args: lexicons.append(learned(*args)) or lexicons[-1]
    )
    table = spark.read.parquet(str(SF / "documents.parquet"))
    marks = spark.read.parquet(str(SF / "labels.parquet"))
    scores = toxicity.score_toxicity(table, marks).select("doc_id", "score").collect()
    trees = [(w, grown(t)) for w, t in zip(boosted[0].treeWeights, boosted[0].trees, strict=True)]
    places, heights = calibrated[0].boundaries.toArray(), calibrated[0].predictions.toArray()
    features = toxicity.feature_function(lexicons[0])
    bodies = {r.doc_id: (r.text or "").encode() for r in table.select("doc_id", "text").collect()}

    def score(body):
        values = features(body)
        margin = sum(w * walked(t, values)[0] for w, t in trees)
        x = 1 / (1 + math.exp(-2 * margin))
        if x <= places[0] or x >= places[-1]:
            return heights[0] if x <= places[0] else heights[-1]
        i = max(i for i, p in enumerate(places) if p <= x)
        share = (x - places[i]) / (places[i + 1] - places[i])
        return heights[i] + share * (heights[i + 1] - heights[i])

    assert len(trees) > 1 and len(scores) == len(bodies)
    assert list(heights) == sorted(heights)
    for r in scores:
        assert r.score == pytest.approx(score(bodies[r.doc_id]), abs=1e-6), r.doc_id


