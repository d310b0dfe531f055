"""Fitted models as column expressions.

A saved or fitted ``PipelineModel`` (assembler + classifier) is compiled into an
expression over its feature columns: logistic regression into the logistic of a
weighted sum, boosted trees into nested ``CASE WHEN``.  Scoring is then a projection:
it runs in generated code without assembled vectors, prunes the scan to the features
that the model uses, and can be a filter or part of any other query.

The structure of trees is read from ``toDebugString``, whose thresholds and
predictions are printed in full.  Sums over many trees are balanced, so that an
ensemble of thousands of trees stays a shallow expression; Spark leaves whole-stage
code for split methods where it grows too long.

A null feature compares as false and goes to the right child (the assembler would
raise an error); NaN goes right in both.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassificationModel, LogisticRegressionModel
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column
from pyspark.sql import functions as F

_TREE = re.compile(r"Tree \d+ \(weight ([-+.\dEe]+)\):")
_SPLIT = re.compile(r"If \(feature (\d+) <= (\S+)\)")
_LEAF = re.compile(r"Predict: (\S+)")


def balanced_sum(terms: list[Column]) -> Column:
    """Sum of the terms as a tree of additions of logarithmic depth."""
    if not terms:
        return F.lit(0.0)
    while len(terms) > 1:
        pairs = [a + b for a, b in zip(terms[::2], terms[1::2])]
        terms = pairs + terms[2 * len(pairs):]
    return terms[0]


def _node(lines: Iterator[str]):
    """The next subtree; uses up its lines."""
    line = next(lines)
    leaf = _LEAF.match(line)
    if leaf:
        return float(leaf[1])
    split = _SPLIT.match(line)
    if not split:
        raise ValueError(f"only splits of numbers are supported: {line}")
    left = _node(lines)
    next(lines)  # the matching Else
    return int(split[1]), float(split[2]), left, _node(lines)


def parsed_trees(model: GBTClassificationModel) -> list[tuple]:
    """(weight, root) of every tree, in the order of boosting.  A node is a prediction or
    (number of the feature, threshold, left node, right node)."""
    out, weight, lines = [], None, []

    def close():
        if weight is not None:
            out.append((weight, _node(iter(lines))))

    for line in map(str.strip, model.toDebugString.splitlines()[1:]):
        head = _TREE.match(line)
        if head:
            close()
            weight, lines = float(head[1]), []
        elif line:
            lines.append(line)
    close()
    return out


def _expression(node, features: list[str]) -> Column:
    if not isinstance(node, tuple):
        return F.lit(node)
    feature, threshold, left, right = node
    return (F.when(F.col(features[feature]) <= F.lit(threshold), _expression(left, features))
            .otherwise(_expression(right, features)))


def tree_expressions(model: GBTClassificationModel, features: list[str]) -> list[Column]:
    """Weighted prediction of every tree, in the order of boosting."""
    return [F.lit(weight) * _expression(root, features) for weight, root in parsed_trees(model)]


def logistic(x: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-x))


def boosted_probability(margin: Column) -> Column:
    """Probability of class 1 at a margin of boosted trees with logistic loss."""
    return logistic(F.lit(2.0) * margin)


def linear_margin(model: LogisticRegressionModel, features: list[str]) -> Column:
    weights = zip(features, model.coefficients.toArray().tolist())
    return balanced_sum([F.lit(float(model.intercept)),
                         *[F.col(f) * F.lit(float(w)) for f, w in weights if w != 0]])


def probability_expression(model: PipelineModel) -> Column:
    """Probability of class 1 as a function of the raw feature columns."""
    features = next(s for s in model.stages if isinstance(s, VectorAssembler)).getInputCols()
    last = model.stages[-1]
    if isinstance(last, GBTClassificationModel):
        return boosted_probability(balanced_sum(tree_expressions(last, features)))
    if isinstance(last, LogisticRegressionModel):
        return logistic(linear_margin(last, features))
    raise TypeError(f"no expression for {type(last).__name__}")
