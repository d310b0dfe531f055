"""Model training on Spark ML.

Logistic regression: the reference minimises ``0.5 * ||w||^2 + C * sum(logloss)``
(C = 10, intercept not penalised).  Spark ML minimises
``mean(logloss) + regParam * 0.5 * ||w||^2``; dividing the first by ``C * n``
gives the second with ``regParam = 1 / (C * n)``.  Features are already
min-max scaled, so ``standardization`` is off (it would change the penalty).

Gradient-boosted trees: depth 3, learning rate 0.5, row subsample 0.08,
feature subsample 0.8, as in the reference.  Spark's GBT is first-order and
samples features per node; its trees are grown by ``models.boost`` over the sampled rows only.  A child needs at least as many rows as the reference's
least child weight implies: that weight sums p(1 - p), which is a quarter at most.
The number of rounds is chosen by a rule: a tenth of the users is held out; the AUC
on them is read after every round; when no round of the last 20 is better than the
best before them, that best number of rounds is used for a fit on all users.  If the
best is among the last 20, the rounds are doubled (40, 80, ... up to 10,000) and the
fit goes on.  The AUC of all rounds of a fit comes from one aggregation of the
held-out rows by (round, score bucket), counted in the tasks that read them; beyond 64
rounds, one for each 64.

Both models are fitted as ``PipelineModel`` (assembler + classifier), so one
object scores a frame of raw feature columns and can be saved and loaded.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassificationModel, LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartwise.models.boost import BoostedTrees
from cartwise.models.expressions import parsed_trees
from cartwise.operators.rank import auc_by_group
from cartwise.operators.split import train_test_by_group
from cartwise.schema import FEATURES, ID_COL, LABEL_COL
from cartwise.session import delete_path, scratch_path

# executors need not import this module
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Fixed values of the reference models.
LR_C = 10.0
LR_MAX_ITER = 2000
GBT_DEPTH = 3
GBT_STEP = 0.5
GBT_SUBSAMPLE = 0.08
GBT_COLSAMPLE = "0.8"
GBT_CHILD_WEIGHT = 0.5
GBT_SEED = 29
GBT_MAX_ROUNDS = 10_000
GBT_PATIENCE = 20
GBT_FIRST_ROUNDS = 40

ROUNDS_AT_ONCE = 64
AUC_BUCKETS = 10_000


def assembler(features: list[str] = FEATURES) -> VectorAssembler:
    # nulls are a data error here (every candidate has all features)
    return VectorAssembler(inputCols=list(features), outputCol="features",
                           handleInvalid="error")


def logistic_regression_estimator(n_train: int, c: float = LR_C,
                                  max_iter: int = LR_MAX_ITER,
                                  label: str = LABEL_COL) -> LogisticRegression:
    return LogisticRegression(
        featuresCol="features", labelCol=label, regParam=1.0 / (c * max(n_train, 1)),
        elasticNetParam=0.0, standardization=False, fitIntercept=True,
        maxIter=max_iter, tol=1e-6, family="binomial",
    )


def gbt_estimator(max_iter: int = 50, seed: int = GBT_SEED,
                  label: str = LABEL_COL) -> BoostedTrees:
    return BoostedTrees(
        featuresCol="features", labelCol=label, maxDepth=GBT_DEPTH, stepSize=GBT_STEP,
        subsamplingRate=GBT_SUBSAMPLE, featureSubsetStrategy=GBT_COLSAMPLE,
        maxIter=max_iter, seed=seed, lossType="logistic",
        minInstancesPerNode=math.ceil(GBT_CHILD_WEIGHT / 0.25),
    )


def _pipeline(estimator, features: list[str]) -> Pipeline:
    return Pipeline(stages=[assembler(features), estimator])


def _labelled(df: DataFrame, label: str) -> DataFrame:
    return df.withColumn(label, F.col(label).cast("double"))


def fit_logistic_regression(train: DataFrame, features: list[str] = FEATURES,
                            label: str = LABEL_COL, n_train: int | None = None,
                            c: float = LR_C, max_iter: int = LR_MAX_ITER) -> PipelineModel:
    n = n_train if n_train is not None else train.count()
    est = logistic_regression_estimator(n, c, max_iter, label)
    return _pipeline(est, features).fit(_labelled(train, label))


def _cell_counter(rounds: int, buckets: int) -> Callable:
    """Counts a task's rows by (round, score bucket, label) from the predictions of each
    row's trees, so that no row is repeated for every round."""
    def count(batches):
        at_round = np.arange(rounds) * (buckets + 1)
        seen = np.zeros((2, rounds * (buckets + 1)), dtype=np.int64)
        for batch in batches:
            trees = batch.column("_t").flatten().to_numpy(zero_copy_only=False).reshape(-1, rounds)
            before = batch.column("_m").to_numpy(zero_copy_only=False)
            positive = batch.column("_p").to_numpy(zero_copy_only=False)
            # summed in the order of boosting; the column before the first tree is dropped
            margins = np.cumsum(np.column_stack([before, trees]), axis=1)[:, 1:]
            with np.errstate(over="ignore"):  # exp may become infinite: a score of zero
                scores = 1.0 / (1.0 + np.exp(-(2.0 * margins)))  # as ``boosted_probability``
            cells = np.floor(scores * buckets).astype(np.int64) + at_round
            for label, rows in enumerate((~positive, positive)):
                seen[label] += np.bincount(cells[rows].ravel(), minlength=seen.shape[1])
        found = np.flatnonzero(seen.any(axis=0))
        yield pa.RecordBatch.from_arrays(
            [pa.array((found // (buckets + 1)).astype(np.int32)), pa.array(found % (buckets + 1)),
             pa.array(seen[1][found]), pa.array(seen[0][found])], names=["_r", "_s", "_pos", "_neg"])

    return count


def _leaves(batch: pa.RecordBatch, trees: list, features: list[str]) -> np.ndarray:
    """Weighted prediction of every tree (column) for every row."""
    # a null compares as false, as NaN does
    x = [batch.column(f).to_numpy(zero_copy_only=False) for f in features]

    def value(node):
        if not isinstance(node, tuple):
            return node
        feature, threshold, left, right = node
        return np.where(x[feature] <= threshold, value(left), value(right))

    out = np.empty((batch.num_rows, len(trees)))
    for k, (weight, root) in enumerate(trees):
        out[:, k] = weight * value(root)
    return out


def _leaf_counter(trees: list, features: list[str], count: Callable) -> Callable:
    """``count`` (a ``_cell_counter``) over rows of features, a part of a batch at a time."""
    def parts(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 1 << 14):
                some = batch.slice(at, 1 << 14)
                ends = np.arange(0, (some.num_rows + 1) * len(trees), len(trees), dtype=np.int32)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(some.column("_y").to_numpy(zero_copy_only=False) == 1), some.column("_m"),
                     pa.ListArray.from_arrays(pa.array(ends), pa.array(_leaves(some, trees, features).ravel()))],
                    names=["_p", "_m", "_t"])

    return lambda batches: count(parts(batches))


def _margin_adder(trees: list, features: list[str]) -> Callable:
    """Rows with the trees added to their margins, in the order of boosting."""
    def run(batches):
        for batch in batches:
            before = batch.column("_m").to_numpy(zero_copy_only=False)
            every = np.column_stack([before, _leaves(batch, trees, features)])
            margin = pa.array(np.cumsum(every, axis=1)[:, -1])
            yield batch.set_column(batch.schema.get_field_index("_m"), "_m", margin)

    return run


def auc_by_round(model: GBTClassificationModel, rows: DataFrame, features: list[str] = FEATURES,
                 label: str = LABEL_COL) -> list[float]:
    """AUC on ``rows`` of the ensemble cut after each of its rounds (0.5 where the rows
    hold one label only), to the resolution of ``AUC_BUCKETS`` equal score buckets."""
    spark, trees = rows.sparkSession, parsed_trees(model)
    out, path = [], None
    now = rows.select(F.col(label).cast("long").alias("_y"),
                      *[F.col(f).cast("double") for f in features], F.lit(0.0).alias("_m"))
    for at in range(0, len(trees), ROUNDS_AT_ONCE):
        some = trees[at:at + ROUNDS_AT_ONCE]
        counts = now.where(F.col("_y").isNotNull()).mapInArrow(
            _leaf_counter(some, features, _cell_counter(len(some), AUC_BUCKETS)),
            "_r int, _s long, _pos long, _neg long")
        found = {r["_r"]: r["auc"] for r in auc_by_group(counts, ["_r"]).collect()}
        out += [found.get(i) for i in range(len(some))]  # one row per round
        if at + ROUNDS_AT_ONCE < len(trees):
            before, path = path, scratch_path(spark, "margins")
            now.mapInArrow(_margin_adder(some, features), now.schema).write.parquet(path)
            now = spark.read.schema(now.schema).parquet(path)
            if before:
                delete_path(spark, before)
    if path:
        delete_path(spark, path)
    return [0.5 if x is None else x for x in out]


def best_round(scores: list[float], patience: int, most: int) -> int | None:
    """The number of rounds with the best score, if that is settled: no later score
    of the last ``patience`` rounds is better, or there may be no more rounds."""
    best = max(range(len(scores)), key=scores.__getitem__)
    return best + 1 if best + patience < len(scores) or len(scores) >= most else None


def boosting_rounds(train: DataFrame, held_out: DataFrame, features: list[str] = FEATURES,
                    label: str = LABEL_COL, seed: int = GBT_SEED, patience: int = GBT_PATIENCE,
                    first: int = GBT_FIRST_ROUNDS, most: int = GBT_MAX_ROUNDS) -> int:
    """How many rounds the held-out AUC asks for (see the module's text)."""
    rounds, kept = min(first, most), {}
    try:
        while True:
            estimator = gbt_estimator(rounds, seed, label).keep(kept)
            model = _pipeline(estimator, features).fit(_labelled(train, label))
            best = best_round(auc_by_round(model.stages[-1], held_out, features, label), patience, most)
            if best is not None:
                return best
            rounds = min(2 * rounds, most)
    finally:
        if kept:
            kept["booster"].release()


def fit_gbt(train: DataFrame, features: list[str] = FEATURES, label: str = LABEL_COL,
            max_iter: int | None = None, seed: int = GBT_SEED,
            group_col: str = ID_COL) -> PipelineModel:
    """``max_iter`` rounds, or as many as the rule chooses on held-out groups."""
    if max_iter is None:
        fit_on, watched = train_test_by_group(train, group_col, 0.1, seed)
        max_iter = boosting_rounds(fit_on, watched, features, label, seed)
    return _pipeline(gbt_estimator(max_iter, seed, label), features).fit(_labelled(train, label))


def positive_probability(model: PipelineModel, df: DataFrame, out: str = "probability_1",
                         keep: list[str] | None = None) -> DataFrame:
    """``df`` (or its ``keep`` columns) + the probability of class 1."""
    scored = model.transform(df)
    cols = keep if keep is not None else df.columns
    return scored.select(*cols, vector_to_array("probability")[1].alias(out))


def feature_importance(spark: SparkSession, lr_model: PipelineModel,
                       gbt_model: PipelineModel,
                       features: list[str] = FEATURES) -> DataFrame:
    """feature, lrm_coef, lrm_abs_coef, gbt_importance: one row per feature
    (a few dozen numbers taken from the fitted models)."""
    coef = lr_model.stages[-1].coefficients.toArray().tolist()
    imp = gbt_model.stages[-1].featureImportances.toArray().tolist()
    schema = T.StructType([
        T.StructField("feature", T.StringType(), False),
        T.StructField("lrm_coef", T.DoubleType(), False),
        T.StructField("lrm_abs_coef", T.DoubleType(), False),
        T.StructField("gbt_importance", T.DoubleType(), False),
    ])
    rows = [(f, float(c), abs(float(c)), float(i)) for f, c, i in zip(features, coef, imp)]
    return spark.createDataFrame(rows, schema)


def top_features(importance: DataFrame, by: str = "lrm_abs_coef", k: int = 10) -> DataFrame:
    return importance.orderBy(F.desc(by), "feature").limit(k)
