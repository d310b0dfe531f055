"""

Every query reads the test tables of ``sf_dir`` (through the fixture adapter,
materialised once per application in the shared checkpoint folder) and runs
over all of them.  Doubles are rounded to 6 decimals in the returned frames
(the library itself returns full precision); ``oracle_sql`` does the same.
Evaluation queries score candidates with a deterministic baseline score
(``percent_in_user_orders``) so that they can be checked exactly; the same
functions take model probabilities in the training/evaluation jobs.
"""

from __future__ import annotations

import os
import sys
from collections.abc import Callable

_HERE = os.path.dirname(os.path.abspath(__file__))
if _HERE not in sys.path:
    sys.path.insert(0, _HERE)

from pyspark.ml.functions import vector_to_array  # noqa: E402
from pyspark.sql import DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402
from pyspark.sql import types as T  # noqa: E402

import oracle_sql as _oracle  # noqa: E402
from cartwise.operators import evaluate as ev  # noqa: E402
from cartwise.operators import features as fx  # noqa: E402
from cartwise.operators import recommend as rec  # noqa: E402
from cartwise.operators.rank import rank_metrics  # noqa: E402
from cartwise.operators import split as sp  # noqa: E402
from cartwise.operators.basket import Basket  # noqa: E402
from cartwise.operators.scale import fit_min_max  # noqa: E402
from cartwise.schema import FEATURES, LINE_COLUMNS  # noqa: E402
from cartwise.models.certify import optimality_certificate  # noqa: E402
from cartwise.models.cv import GroupCrossValidation  # noqa: E402
from cartwise.models.expressions import probability_expression  # noqa: E402
from cartwise.models.train import (feature_importance, logistic_regression_estimator,  # noqa: E402
                                   positive_probability)
from cartwise.plans.build import train_from_matrix  # noqa: E402
from cartwise.sources import history  # noqa: E402

SF_SMOKE = "/root/testdata/sf0.001"

SPLIT_SEED = _oracle.SPLIT_SEED
TEST_SIZE = _oracle.TEST_SIZE
NUM_FOLDS = _oracle.NUM_FOLDS
THRESHOLD = _oracle.THRESHOLD
ADJUSTED_THRESHOLD = _oracle.ADJUSTED_THRESHOLD
F1_TARGET = _oracle.F1_TARGET
TOP_K = _oracle.TOP_K
USER_LIMIT = _oracle.USER_LIMIT


def _rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    return df.select(*[
        F.round(F.col(f.name), digits).alias(f.name)
        if isinstance(f.dataType, T.DoubleType) else F.col(f.name)
        for f in df.schema.fields])


def _basket(spark: SparkSession, sf_dir: str, grain: str = "brand") -> Basket:
    return Basket.from_history(*history.order_history(spark, sf_dir, grain))


def _matrix(spark, sf_dir) -> DataFrame:
    """The feature matrix as the evaluation queries read it: built once per
    application and saved (the ``feature_matrix`` query computes it anew)."""
    return history.feature_matrix_table(spark, sf_dir)


def _scores(spark, sf_dir) -> DataFrame:
    """Test-split candidates with the baseline score, read from the saved
    test set (the ``group_split_*`` queries compute the split themselves)."""
    test = history.test_set_table(spark, sf_dir, TEST_SIZE, SPLIT_SEED)
    return test.select("user_id", "product_id", "in_cart",
                       F.col("percent_in_user_orders").alias("score"))


def _feature(fn):
    return lambda spark, sf_dir: _rounded(fn(_basket(spark, sf_dir)))


def q_load_prior(spark, sf_dir):
    return history.basket_tables(spark, sf_dir)[0].select(*LINE_COLUMNS)


def q_load_newest(spark, sf_dir):
    return history.basket_tables(spark, sf_dir)[1].select(*LINE_COLUMNS)


def q_user_limit(spark, sf_dir):
    return history.basket_tables(spark, sf_dir, user_limit=USER_LIMIT)[0].select(*LINE_COLUMNS)


def q_distinct_users(spark, sf_dir):
    return history.basket_tables(spark, sf_dir)[0].select("user_id").distinct()


def q_top_products(spark, sf_dir):
    return fx.top_products(_basket(spark, sf_dir), 10)


def q_feature_matrix(spark, sf_dir):
    return _rounded(fx.feature_matrix(_basket(spark, sf_dir)))


def q_feature_matrix_part_grain(spark, sf_dir):
    """Same matrix with product = part: many products, sparse repeats."""
    return _rounded(fx.feature_matrix(_basket(spark, sf_dir, "part")))


def q_matrix_shape(spark, sf_dir):
    m = fx.feature_matrix(_basket(spark, sf_dir))
    return m.agg(F.count(F.lit(1)).alias("n_rows")).select(
        "n_rows", F.lit(len(m.columns)).cast("int").alias("n_columns"))


def q_group_split_train(spark, sf_dir):
    m = _matrix(spark, sf_dir).select("user_id", "product_id", "in_cart")
    return sp.train_test_by_group(m, "user_id", TEST_SIZE, SPLIT_SEED)[0]


def q_group_split_test(spark, sf_dir):
    m = _matrix(spark, sf_dir).select("user_id", "product_id", "in_cart")
    return sp.train_test_by_group(m, "user_id", TEST_SIZE, SPLIT_SEED)[1]


def q_group_folds(spark, sf_dir):
    # the oracle ranks with the split seed too
    return sp.group_folds(_matrix(spark, sf_dir), "user_id", NUM_FOLDS, SPLIT_SEED)


def q_minmax_scale(spark, sf_dir):
    m = sp.with_split(_matrix(spark, sf_dir), "user_id", TEST_SIZE, SPLIT_SEED)
    model = fit_min_max(m.where(F.col("split") == "train"), FEATURES)  # a scan and a filter
    return _rounded(model.transform(m.select("split", "user_id", "product_id", "in_cart",
                                             *FEATURES)))


def q_apply_threshold(spark, sf_dir):
    return _rounded(ev.with_prediction(_scores(spark, sf_dir), THRESHOLD))


def q_overall_metrics(spark, sf_dir):
    return _rounded(ev.overall_metrics(_scores(spark, sf_dir), THRESHOLD))


def q_overall_metrics_adjusted(spark, sf_dir):
    return _rounded(ev.overall_metrics(_scores(spark, sf_dir), ADJUSTED_THRESHOLD))


def q_threshold_sweep(spark, sf_dir):
    return _rounded(ev.threshold_sweep(_scores(spark, sf_dir), 100))


def q_best_threshold(spark, sf_dir):
    best = ev.best_threshold(ev.threshold_sweep(_scores(spark, sf_dir), 100))
    return _rounded(best.select("threshold", "f1"))


def q_user_threshold_sweep(spark, sf_dir):
    return _rounded(ev.user_threshold_sweep(_scores(spark, sf_dir), 100))


def q_best_user_threshold(spark, sf_dir):
    return _rounded(ev.best_user_threshold(ev.user_threshold_sweep(_scores(spark, sf_dir), 100)))


def _per_user(spark, sf_dir):
    return ev.per_user_f1(_scores(spark, sf_dir), ADJUSTED_THRESHOLD)


def q_per_user_f1(spark, sf_dir):
    return _rounded(_per_user(spark, sf_dir))


def q_mean_user_f1(spark, sf_dir):
    return _rounded(ev.mean_user_f1(_per_user(spark, sf_dir)))


def q_f1_histogram(spark, sf_dir):
    return _rounded(ev.f1_histogram(_per_user(spark, sf_dir), 19))


def q_users_with_f1(spark, sf_dir):
    return ev.users_with_f1(_per_user(spark, sf_dir), F1_TARGET)


def _fold_scored(spark, sf_dir):
    m = _matrix(spark, sf_dir)
    folded = sp.with_folds(m, "user_id", NUM_FOLDS, SPLIT_SEED)
    return folded.withColumn("score", F.col("percent_in_user_orders"))


def q_cv_fold_scores(spark, sf_dir):
    return _rounded(ev.fold_scores(_fold_scored(spark, sf_dir), ADJUSTED_THRESHOLD))


def q_cv_score(spark, sf_dir):
    return _rounded(ev.mean_fold_score(ev.fold_scores(_fold_scored(spark, sf_dir), ADJUSTED_THRESHOLD)))


def q_recommend_for_user(spark, sf_dir):
    return _rounded(rec.recommend_for_user(_scores(spark, sf_dir),
                                           history.products(spark, sf_dir)))


def q_recommend_topk(spark, sf_dir):
    every = _matrix(spark, sf_dir).select("user_id", "product_id",
                                          F.col("percent_in_user_orders").alias("score"))
    return _rounded(rec.recommend_topk(every, TOP_K))


def q_recommend_topk_products(spark, sf_dir):
    """Every user's list with name, aisle and department, from the product CSV."""
    every = _matrix(spark, sf_dir).select("user_id", "product_id",
                                          F.col("percent_in_user_orders").alias("score"))
    return _rounded(rec.recommend_topk(every, TOP_K, products=history.product_attributes(spark, sf_dir)))


# ---- model queries (no SQL oracle unless stated: rows-only) ----------------------------
_TRAINED: dict = {}


def _trained(spark, sf_dir):
    key = (spark.sparkContext.applicationId, os.path.abspath(sf_dir))
    if key not in _TRAINED:
        _TRAINED[key] = train_from_matrix(spark, _matrix(spark, sf_dir))
    return _TRAINED[key]


def _model_scores(model, test):
    scored = positive_probability(model, test, out="probability",
                                  keep=["user_id", "product_id", "in_cart"])
    return _rounded(ev.with_prediction(scored, THRESHOLD, "probability"))


def q_logreg_scores(spark, sf_dir):
    r = _trained(spark, sf_dir)
    return _model_scores(r.lr, r.test)


def q_gbt_scores(spark, sf_dir):
    r = _trained(spark, sf_dir)
    return _model_scores(r.gbt, r.test)


def q_logreg_certificate(spark, sf_dir):
    """Gradient of the penalised objective at the fitted model, by feature: zero at
    the optimum.  Rounded as every double here, to a millionth of the per-row loss."""
    r = _trained(spark, sf_dir)
    found = optimality_certificate(r.lr, r.train)
    # adding zero turns a rounded -0.0 into 0.0
    return found.select("feature", *[(F.round(c, 6) + F.lit(0.0)).alias(c) for c in ("gradient", "gap")])


def q_expression_scores(spark, sf_dir):
    """Rows of the test set that each model scores otherwise as a column expression
    (difference over 1e-9) than as a Spark ML model, and how many were compared."""
    r = _trained(spark, sf_dir)
    parts = []
    for name, model in (("gbt", r.gbt), ("lr", r.lr)):
        both = model.transform(r.test).select(
            vector_to_array("probability")[1].alias("p"), probability_expression(model).alias("q"))
        parts.append(both.agg(F.count(F.lit(1)).alias("n_rows"),
                              F.count_if(~F.coalesce(F.abs(F.col("p") - F.col("q")) <= 1e-9, F.lit(False)))
                              .alias("n_different"))
                     .select(F.lit(name).alias("model"), "n_rows", "n_different"))
    return parts[0].unionByName(parts[1])


def q_cv_fold_auc(spark, sf_dir):
    return _rounded(rank_metrics(_fold_scored(spark, sf_dir), "score", "in_cart", ["fold"]))


def q_feature_importance(spark, sf_dir):
    r = _trained(spark, sf_dir)
    return _rounded(feature_importance(spark, r.lr, r.gbt))


def _cross_validation(spark, sf_dir, frame):
    return GroupCrossValidation(frame, FEATURES, "in_cart", "user_id", NUM_FOLDS, SPLIT_SEED,
                                item_col="product_id")


def q_cv_out_of_fold(spark, sf_dir):
    r = _trained(spark, sf_dir)
    cv = _cross_validation(spark, sf_dir, r.train)
    n = r.train.count()
    cv.fit(logistic_regression_estimator(n * (NUM_FOLDS - 1) // NUM_FOLDS))
    return _rounded(cv.predict(ADJUSTED_THRESHOLD))


def q_cv_out_of_fold_keys(spark, sf_dir):
    """Key, fold and actual label of every out-of-fold row, over all users."""
    return _cross_validation(spark, sf_dir, _matrix(spark, sf_dir)).get_actual()


_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "load_prior": q_load_prior,
    "load_newest": q_load_newest,
    "user_limit": q_user_limit,
    "distinct_users": q_distinct_users,
    "candidates": _feature(fx.candidates),
    "target": _feature(fx.target),
    "rate_by_user": _feature(fx.rate_by_user),
    "rate_overall": _feature(fx.rate_overall),
    "top_products": q_top_products,
    "in_last_cart": _feature(fx.in_last_cart),
    "order_timeline": _feature(fx.order_timeline),
    "in_last_five": _feature(fx.in_last_five),
    "reorder_gaps": _feature(fx.reorder_gaps),
    "time_since_order": _feature(fx.time_since_order),
    "product_proba": _feature(fx.product_proba),
    "user_proba": _feature(fx.user_proba),
    "mean_order": _feature(fx.mean_order),
    "newest_order": _feature(fx.newest_order),
    "feature_matrix": q_feature_matrix,
    "feature_matrix_part_grain": q_feature_matrix_part_grain,
    "matrix_shape": q_matrix_shape,
    "group_split_train": q_group_split_train,
    "group_split_test": q_group_split_test,
    "group_folds": q_group_folds,
    "minmax_scale": q_minmax_scale,
    "apply_threshold": q_apply_threshold,
    "overall_metrics": q_overall_metrics,
    "overall_metrics_adjusted": q_overall_metrics_adjusted,
    "threshold_sweep": q_threshold_sweep,
    "best_threshold": q_best_threshold,
    "user_threshold_sweep": q_user_threshold_sweep,
    "best_user_threshold": q_best_user_threshold,
    "per_user_f1": q_per_user_f1,
    "mean_user_f1": q_mean_user_f1,
    "f1_histogram": q_f1_histogram,
    "users_with_f1": q_users_with_f1,
    "cv_fold_scores": q_cv_fold_scores,
    "cv_score": q_cv_score,
    "recommend_for_user": q_recommend_for_user,
    "recommend_topk": q_recommend_topk,
    "recommend_topk_products": q_recommend_topk_products,
    "logreg_scores": q_logreg_scores,
    "gbt_scores": q_gbt_scores,
    "logreg_certificate": q_logreg_certificate,
    "expression_scores": q_expression_scores,
    "cv_fold_auc": q_cv_fold_auc,
    "feature_importance": q_feature_importance,
    "cv_out_of_fold": q_cv_out_of_fold,
    "cv_out_of_fold_keys": q_cv_out_of_fold_keys,
}


def _llm():
    """The llm subpackage's registry, or None where that subpackage (or the
    pipeline module that belongs to it) is absent.  Other errors are raised."""
    try:
        from cartwise.llm import registry
    except ModuleNotFoundError as e:
        if (e.name or "").split(".")[:2] == ["cartwise", "llm"] or e.name == "corpus_pipeline":
            return None
        raise
    except ImportError as e:
        if e.name == "cartwise.llm":  # an empty folder left behind imports as a namespace
            return None
        raise
    return registry


_LLM = _llm()


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: the labelled 18-feature matrix on sf0.001."""
    return q_feature_matrix(spark, SF_SMOKE)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {**_QUERIES, **(_LLM.QUERIES if _LLM else {})}


def oracle_sql() -> dict[str, str]:
    own = {k: v for k, v in _oracle.QUERIES.items() if k in _QUERIES}
    return {**own, **(_LLM.ORACLES if _LLM else {})}
