"""Rules that replaced fixed settings, and outputs that had no test."""

import numpy as np
import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import functions as F

from cartwise.models.cv import GroupCrossValidation
from cartwise.models.train import (boosting_rounds, feature_importance, fit_gbt,
                                   fit_logistic_regression, gbt_estimator,
                                   logistic_regression_estimator, positive_probability, top_features)
from cartwise.operators import evaluate as ev
from cartwise.operators import recommend as rec
from cartwise.operators.split import train_test_by_group
from cartwise.plans import build
from cartwise.plans.evaluate import evaluate_models
from cartwise.sources.artefacts import ArtefactStore

FEATS = ["a", "b", "c"]


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(8)
    n = 1200
    x = rng.uniform(size=(n, 3))
    y = (rng.uniform(size=n) < 1 / (1 + np.exp(-(6 * np.abs(x[:, 0] - 0.5) - 3 * x[:, 1])))).astype(int)
    rows = [(i // 6, i, int(y[i]), *map(float, x[i])) for i in range(n)]
    return spark.createDataFrame(rows, "user_id long, product_id long, in_cart int, "
                                       "a double, b double, c double").cache()


def test_boosting_rounds_stop_by_the_rule_and_beat_one_feature(data):
    train, held = train_test_by_group(data, "user_id", 0.3, 2)
    rounds = boosting_rounds(train, held, FEATS, patience=5, first=10, most=40)
    assert 1 <= rounds <= 40
    model = fit_gbt(train, FEATS, max_iter=rounds)
    scored = positive_probability(model, held, keep=["in_cart", "a"])
    auc = BinaryClassificationEvaluator(labelCol="in_cart", rawPredictionCol="probability_1")
    base = BinaryClassificationEvaluator(labelCol="in_cart", rawPredictionCol="a")
    assert auc.evaluate(scored) > max(0.6, base.evaluate(scored))


def test_rounds_grow_until_the_best_is_behind(monkeypatch, data):
    asked = []

    class Fitted:
        def __init__(self, n):
            self.n = n
            self.stages = [self]

        def fit(self, df):
            return self

    monkeypatch.setattr("cartwise.models.train._pipeline",
                        lambda est, feats: asked.append(est.getMaxIter()) or Fitted(est.getMaxIter()))
    monkeypatch.setattr("cartwise.models.train.auc_by_round",
                        lambda model, *_: [1 - abs(i - 70) / 10_000 for i in range(model.n)])
    assert boosting_rounds(data, data, FEATS) == 71
    assert asked == [40, 80, 160]


def test_cross_validation_with_trees_keys_and_evaluator(data):
    cv = GroupCrossValidation(data, FEATS, "in_cart", "user_id", 3, 5, item_col="product_id")
    cv.fit(gbt_estimator(3))
    predicted = cv.predict(0.4)
    actual = cv.get_actual()
    keys = ["user_id", "product_id", "fold", "in_cart"]
    assert actual.columns == keys and predicted.columns == [*keys, "probability_1", "prediction"]
    assert {tuple(r) for r in predicted.select(*keys).collect()} == {tuple(r) for r in actual.collect()}
    scores, mean = cv.score(0.4, BinaryClassificationEvaluator(labelCol="in_cart"))
    assert len(scores) == 3 and mean == pytest.approx(sum(scores) / 3) and mean > 0.5


def test_top_features(spark, data):
    lr = fit_logistic_regression(data, FEATS)
    imp = feature_importance(spark, lr, fit_gbt(data, FEATS, max_iter=2), FEATS)
    top = top_features(imp, k=2).collect()
    rows = sorted(imp.collect(), key=lambda r: -r.lrm_abs_coef)
    assert [r.feature for r in top] == [r.feature for r in rows[:2]]


def test_null_and_nan_scores_count_alike_everywhere(spark):
    rows = [(1, None, 1), (1, 0.9, 1), (2, 0.2, 0), (2, float("nan"), 1)]
    df = spark.createDataFrame(rows, "user_id long, score double, in_cart int")
    for t in (0.5, 1.0):
        one = ev.overall_metrics(df, t).first()
        swept = ev.threshold_sweep(df, 100).where(F.abs(F.col("threshold") - t) < 1e-9).first()
        assert (one.tp, one.fp, one.fn, one.f1) == (swept.tp, swept.fp, swept.fn, swept.f1)
    half = ev.overall_metrics(df.limit(3), 0.5).first()
    assert half.fn == 1 and half.f1 == pytest.approx(2 / 3)
    assert sum(r.fn for r in ev.per_user_f1(df, 0.5).collect()) == 1


def test_all_users_with_an_f1_are_listed(spark):
    df = spark.range(50).select(F.col("id").alias("user_id"), F.lit(0.8).alias("f1"))
    assert ev.users_with_f1(df).count() == 50 and ev.users_with_f1(df, limit=10).count() == 10


def test_recommendations_keep_product_columns(spark):
    scores = spark.createDataFrame([(1, 10, 0.5), (1, 11, 0.9)], "user_id long, product_id long, score double")
    products = spark.createDataFrame([(10, "ten", 4), (11, "eleven", 5)],
                                     "product_id long, product_name string, aisle_id int")
    rows = rec.recommend_for_user(scores, products, 1).collect()
    assert [tuple(r) for r in rows] == [(1, 11, "eleven", 5, 0.9), (1, 10, "ten", 4, 0.5)]


def test_evaluation_writes_its_tables(spark, data, tmp_path):
    lr, gbt = fit_logistic_regression(data, FEATS), fit_gbt(data, FEATS, max_iter=3)
    out = evaluate_models(spark, data, lr, gbt, FEATS, str(tmp_path))
    store = ArtefactStore(spark, str(tmp_path))
    current = store.current()
    for name in ("lr", "gbt"):
        saved = spark.read.parquet(store.path(current, f"user_f1_{name}"))
        assert saved.count() == 200
        by_threshold = spark.read.parquet(store.path(current, f"user_thresholds_{name}")).collect()
        best = out[name]["best_user_threshold"]
        assert len(by_threshold) == 101 and best["n_users"] == 200
        assert best["mean_f1"] == pytest.approx(max(r.mean_f1 for r in by_threshold))
        assert out[name]["mean_user_f1"] == pytest.approx(saved.agg(F.avg("f1")).first()[0], abs=6e-4)
    assert spark.read.parquet(store.path(current, "feature_importance")).count() == 3


def test_a_failed_save_is_an_error(spark, data, tmp_path, monkeypatch):
    monkeypatch.setattr(build, "save_model", lambda model, path: False)
    matrix = data
    monkeypatch.setattr(build, "FEATURES", FEATS)
    with pytest.raises(OSError):
        build.train_from_matrix(spark, matrix, str(tmp_path), gbt_iter=1)


def test_master_is_passed_on(monkeypatch):
    from cartwise import __main__ as cli

    monkeypatch.setattr(cli, "local_session", lambda cores: ("local", cores))
    monkeypatch.setattr(cli, "session_on", lambda master: ("on", master))
    assert cli._session("local[4]") == ("local", "4") and cli._session("local[*]") == ("local", "*")
    assert cli._session("local") == ("local", "1")
    assert cli._session("yarn") == ("on", "yarn") and cli._session("spark://h:7077") == ("on", "spark://h:7077")
