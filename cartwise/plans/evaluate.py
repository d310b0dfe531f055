"""Evaluation job: probabilities of both models on the test set, F1 at the
default and adjusted thresholds, mean per-user F1, the best thresholds for overall
and for mean per-user F1 from sweeps, per-user F1 histograms and feature
importances.  Only one-row or few-row results reach the driver."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwise.models.train import feature_importance, positive_probability
from cartwise.operators import evaluate as ev
from cartwise.schema import FEATURES, ID_COL, ITEM_COL, LABEL_COL
from cartwise.session import delete_path, scratch_path
from cartwise.sources.artefacts import ArtefactStore
from cartwise.sources.sinks import write_table

# Thresholds used by the reference evaluation.
BASE_THRESHOLD = 0.5
ADJUSTED = {"lr": 0.17, "gbt": 0.21}
PER_USER = {"lr": 0.16, "gbt": 0.17}


def model_scores(model: PipelineModel, test: DataFrame) -> DataFrame:
    return positive_probability(model, test, out="score", keep=[ID_COL, ITEM_COL, LABEL_COL])


def _at(sweep: list[dict], threshold: float) -> dict:
    """The row of a fixed threshold (all of them lie on the sweep's grid)."""
    return min(sweep, key=lambda r: abs(r["threshold"] - threshold))


def _ratio(num: int, den: int) -> float:
    return num / den if den else 0.0


def evaluate_models(spark: SparkSession, test: DataFrame, lr: PipelineModel,
                    gbt: PipelineModel, features: list[str] = FEATURES,
                    out_dir: str | None = None) -> dict:
    """Figures of both models.  Each model scores the test set once (written to
    the scratch folder); all fixed thresholds are read from one sweep.  With
    ``out_dir``, each model's per-user F1 and mean F1 by threshold and the importances
    are saved there, published together with the artefacts published before."""
    if not out_dir:
        return _evaluate(spark, test, lr, gbt, features, None)
    store = ArtefactStore(spark, out_dir)
    base = store.current()
    with store.begin() as run:
        out = _evaluate(spark, test, lr, gbt, features, run)
        run.publish(base)
    return out


def _evaluate(spark, test, lr, gbt, features, run) -> dict:
    out: dict = {}
    for name, model in (("lr", lr), ("gbt", gbt)):
        path = scratch_path(spark, f"scores-{name}")
        model_scores(model, test).write.parquet(path)
        scores = spark.read.parquet(path)
        sweep = [r.asDict() for r in ev.threshold_sweep(scores).collect()]  # 101 rows
        base, adj = _at(sweep, BASE_THRESHOLD), _at(sweep, ADJUSTED[name])
        best = max(sweep, key=lambda r: (r["f1"], -r["threshold"]))
        by_user = [r.asDict() for r in ev.user_threshold_sweep(scores).collect()]  # 101 rows
        best_user = max(by_user, key=lambda r: (round(r["mean_f1"] or 0.0, 9), -r["threshold"]))
        per_user = ev.per_user_f1(scores, PER_USER[name])
        if run:
            write_table(spark.createDataFrame(by_user, "threshold double, n_users long, mean_f1 double"),
                        run.part(f"user_thresholds_{name}"))
            write_table(per_user, run.part(f"user_f1_{name}"))
        mean_user = ev.mean_user_f1(per_user).first()["mean_f1"]
        hist = [r.asDict() for r in ev.f1_histogram(per_user).orderBy("bin").collect()]
        out[name] = {
            "f1_base": round(base["f1"], 3),
            "precision_base": _ratio(base["tp"], base["tp"] + base["fp"]),
            "recall_base": _ratio(base["tp"], base["tp"] + base["fn"]),
            "f1_adjusted": round(adj["f1"], 3),
            "adjusted_threshold": ADJUSTED[name], "mean_user_f1": round(mean_user or 0.0, 3),
            "per_user_threshold": PER_USER[name], "best_threshold": best,
            "best_user_threshold": best_user,
            "f1_histogram": hist,
        }
        delete_path(spark, path)
    imp = feature_importance(spark, lr, gbt, features)
    if run:
        write_table(imp, run.part("feature_importance"))
    out["importance"] = [r.asDict() for r in imp.orderBy(F.desc("lrm_abs_coef")).collect()]
    return out
