"""Cross-validation with folds made of whole groups.

``GroupCrossValidation`` assigns every group (user) to one of ``num_folds``
folds (see ``operators.split``), fits one copy of an estimator per fold on the
other folds, and predicts each fold with the model that did not see it.  The
per-fold score is one ``groupBy(fold)`` aggregation, not a loop of jobs.

The rows are stored once, partitioned by ``fold``: a fold's prediction lists and
reads that fold's files only, a fit those of the others.  Fits are independent and
submitted from a few threads, which keep the caller's job group and local
properties; the stages of one fill the executors that another's last tasks leave idle.
"""

from __future__ import annotations

import threading
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.evaluation import Evaluator
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwise.models.train import assembler
from cartwise.operators.evaluate import f1_metric, fold_scores
from cartwise.operators.rank import rank_metrics
from cartwise.operators.split import with_folds
from cartwise.session import delete_path, scratch_path


class GroupCrossValidation:
    """``store=False`` reads ``df`` itself for every fold (a filter instead of the
    stored partitions).  ``parallelism``: fits and per-fold evaluations at a time."""

    def __init__(self, df: DataFrame, feature_cols: list[str], target_col: str,
                 group_col: str, num_folds: int = 5, seed: int | None = None,
                 store: bool = True, item_col: str | None = None, parallelism: int = 3):
        self.feature_cols = list(feature_cols)
        self.target_col = target_col
        self.group_col = group_col
        self.num_folds = num_folds
        self.parallelism = parallelism
        #: what ties an out-of-fold row to its input row
        self.keys = [group_col] + ([item_col] if item_col else [])
        # the fold is a comparison with a few boundary groups, decided in the scan
        self.folded = with_folds(df, group_col, num_folds, seed)
        self._store, self._path, self._lock = store, None, threading.Lock()
        self.models: list[PipelineModel] = []

    @property
    def df(self) -> DataFrame:
        """Rows with their fold; stored by it at the first use."""
        if not self._store:
            return self.folded
        with self._lock:
            if self._path is None:
                path = scratch_path(self.folded.sparkSession, "cv-folds")
                self.folded.write.partitionBy("fold").parquet(path)
                self._path = path
        return self.folded.sparkSession.read.schema(self.folded.schema).parquet(self._path)

    def _each(self, work: Callable) -> list:
        """``work(fold)`` for every fold, a few at a time, in the order of the folds."""
        self.df  # noqa: B018  (stored before the threads start)
        with ThreadPoolExecutor(max(1, min(self.parallelism, self.num_folds))) as pool:
            # wrapped for each fold: a wrapper carries its own copy of the properties
            spark = self.folded.sparkSession
            jobs = [pool.submit(inheritable_thread_target(spark)(work), k) for k in range(self.num_folds)]
            return [j.result() for j in jobs]

    def fit(self, estimator) -> list[PipelineModel]:
        """One model per fold, each fitted on the rows of the other folds."""
        def one(k):
            data = self.df.withColumn(self.target_col, F.col(self.target_col).cast("double"))
            pipe = Pipeline(stages=[assembler(self.feature_cols), estimator.copy()])
            return pipe.fit(data.where(F.col("fold") != k))

        self.models = self._each(one)
        return self.models

    def predict_proba(self) -> DataFrame:
        """Out-of-fold probabilities: keys, fold, target, probability_1."""
        parts = []
        for k, model in enumerate(self.models):
            part = model.transform(self.df.where(F.col("fold") == k))
            parts.append(part.select(*self.keys, "fold", self.target_col,
                                     vector_to_array("probability")[1].alias("probability_1")))
        return reduce(DataFrame.unionByName, parts)

    def predict(self, threshold: float = 0.5) -> DataFrame:
        """Out-of-fold 0/1 predictions; probability >= threshold is positive."""
        return self.predict_proba().withColumn(
            "prediction", (F.col("probability_1") >= F.lit(float(threshold))).cast("int"))

    def get_actual(self) -> DataFrame:
        """Keys, fold and label of every row, as :meth:`predict` has them."""
        return self.folded.select(*self.keys, "fold", self.target_col)

    def release(self) -> None:
        """Delete the stored rows, if there are any."""
        if self._path:
            delete_path(self.folded.sparkSession, self._path)
            self._path = None

    def get_df_folds(self, limit_cols: bool = True) -> list[DataFrame]:
        cols = (self.feature_cols + [self.target_col]) if limit_cols else self.df.columns
        return [self.df.where(F.col("fold") == k).select(*cols) for k in range(self.num_folds)]

    def score(self, threshold: float = 0.5, scorer=f1_metric) -> tuple[list[float], float]:
        """(score per fold, mean score) over the out-of-fold predictions.
        ``scorer`` maps (tp, fp, fn, tn) columns to a metric (default: F1 of the
        positive class), all folds in one aggregation; or it is a Spark ML
        ``Evaluator`` (of label and raw prediction), run once per fold."""
        if isinstance(scorer, Evaluator):
            return self._evaluated(scorer)
        per_fold = fold_scores(self.predict_proba(), threshold, "probability_1",
                               self.target_col, scorer=scorer, name="score")
        rows = per_fold.orderBy("fold").collect()  # one row per fold
        scores = [r["score"] for r in rows]
        return scores, (sum(scores) / len(scores) if scores else float("nan"))

    def rank_metrics(self) -> DataFrame:
        """fold, n_rows, n_positive, auc, log_loss of the out-of-fold probabilities:
        all folds in one aggregation."""
        return rank_metrics(self.predict_proba(), "probability_1", self.target_col, ["fold"])

    def _evaluated(self, evaluator: Evaluator) -> tuple[list[float], float]:
        label = evaluator.getOrDefault("labelCol")

        def one(k):
            data = self.df.where(F.col("fold") == k).withColumn(label, F.col(self.target_col).cast("double"))
            return evaluator.evaluate(self.models[k].transform(data))

        scores = self._each(one)
        return scores, (sum(scores) / len(scores) if scores else float("nan"))
