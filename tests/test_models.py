import numpy as np
import pytest
from pyspark.sql import functions as F

from cartwise.models.cv import GroupCrossValidation
from cartwise.models.train import (feature_importance, fit_gbt, fit_logistic_regression,
                                   logistic_regression_estimator, positive_probability)
from cartwise.operators.scale import fit_min_max
from cartwise.plans.build import BuildResult, load_or_build
from cartwise.sources.sinks import load_model, save_model, write_table

FEATS = ["a", "b", "c"]


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(3)
    n = 400
    X = rng.uniform(0, 1, size=(n, 3))
    logit = 2.0 * X[:, 0] - 3.0 * X[:, 1] + 0.5
    y = (rng.uniform(size=n) < 1 / (1 + np.exp(-logit))).astype(int)
    users = np.arange(n) // 4
    rows = [(int(u), int(i), int(t), *map(float, x)) for i, (u, t, x) in
            enumerate(zip(users, y, X))]
    df = spark.createDataFrame(rows, "user_id long, product_id long, in_cart int, "
                                     "a double, b double, c double")
    return df, X, y


def _newton(X, y, C):
    """Minimise 0.5*||w||^2 + C*sum(logloss) (intercept unpenalised)."""
    n, d = X.shape
    Xb = np.hstack([X, np.ones((n, 1))])
    w = np.zeros(d + 1)
    reg = np.eye(d + 1)
    reg[-1, -1] = 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-Xb @ w))
        g = reg @ w + C * Xb.T @ (p - y)
        H = reg + C * (Xb.T * (p * (1 - p))) @ Xb
        w = w - np.linalg.solve(H, g)
    return w


def test_logistic_regression_matches_newton_solution(data):
    df, X, y = data
    model = fit_logistic_regression(df, FEATS, n_train=len(y), c=10.0)
    lr = model.stages[-1]
    w = _newton(X, y, 10.0)
    assert np.allclose(lr.coefficients.toArray(), w[:3], atol=1e-4)
    assert lr.intercept == pytest.approx(w[3], abs=1e-4)


def test_gbt_save_load_roundtrip(spark, data, tmp_path):
    df, _, _ = data
    model = fit_gbt(df, FEATS, max_iter=5)
    path = str(tmp_path / "gbt")
    assert save_model(model, path)
    again = load_model(path)
    a = positive_probability(model, df, keep=["product_id"]).orderBy("product_id").collect()
    b = positive_probability(again, df, keep=["product_id"]).orderBy("product_id").collect()
    assert a == b
    assert load_model(str(tmp_path / "missing")) is None


def test_feature_importance_table(spark, data):
    df, _, _ = data
    lr = fit_logistic_regression(df, FEATS, n_train=df.count())
    gbt = fit_gbt(df, FEATS, max_iter=5)
    imp = feature_importance(spark, lr, gbt, FEATS).collect()
    assert [r.feature for r in imp] == FEATS
    assert all(r.lrm_abs_coef == abs(r.lrm_coef) for r in imp)
    assert sum(r.gbt_importance for r in imp) == pytest.approx(1.0)


def test_group_cross_validation(data):
    df, _, _ = data
    cv = GroupCrossValidation(df, FEATS, "in_cart", "user_id", num_folds=4, seed=1)
    cv.fit(logistic_regression_estimator(300))
    oof = cv.predict(0.5)
    assert oof.count() == df.count()
    # every user is predicted by exactly one fold's model
    assert oof.groupBy("user_id").agg(F.countDistinct("fold").alias("k")) \
              .where("k > 1").count() == 0
    scores, mean = cv.score(0.5)
    assert len(scores) == 4 and mean == pytest.approx(sum(scores) / 4)
    from cartwise.operators.evaluate import recall_from_counts
    rec, _ = cv.score(0.5, scorer=recall_from_counts)
    assert all(0.0 <= x <= 1.0 for x in rec)
    folds = cv.get_df_folds()
    assert sum(f.count() for f in folds) == df.count()
    assert folds[0].columns == FEATS + ["in_cart"]


def test_min_max_scaler_semantics(spark):
    train = spark.createDataFrame([(1.0, 5.0), (3.0, 5.0)], "x double, k double")
    test = spark.createDataFrame([(4.0, 7.0), (0.0, 5.0)], "x double, k double")
    m = fit_min_max(train, ["x", "k"])
    tr = [tuple(r) for r in m.transform(train).collect()]
    te = [tuple(r) for r in m.transform(test).collect()]
    assert tr == [(0.0, 0.0), (1.0, 0.0)]          # constant column -> 0
    assert te == [(1.5, 2.0), (-0.5, 0.0)]         # outside the range: not clipped


def test_load_or_build(spark, data, tmp_path):
    df, _, _ = data
    out = str(tmp_path / "art")
    calls = []

    def build():
        calls.append(1)
        lr = fit_logistic_regression(df, FEATS, n_train=400)
        gbt = fit_gbt(df, FEATS, max_iter=3)
        write_table(df, out + "/test_set")
        save_model(lr, out + "/model_lr")
        save_model(gbt, out + "/model_gbt")
        return BuildResult(df, df, lr, gbt)

    load_or_build(spark, out, build)
    r = load_or_build(spark, out, build)
    assert len(calls) == 1 and r.test.count() == 400
    load_or_build(spark, out, build, force_rebuild=True)
    assert len(calls) == 2


def test_evaluation_job(spark, data):
    from cartwise.plans.evaluate import evaluate_models

    df, _, _ = data
    lr = fit_logistic_regression(df, FEATS, n_train=400)
    gbt = fit_gbt(df, FEATS, max_iter=3)
    out = evaluate_models(spark, df, lr, gbt, FEATS)
    for name in ("lr", "gbt"):
        r = out[name]
        assert 0.0 <= r["f1_base"] <= 1.0 and 0.0 <= r["mean_user_f1"] <= 1.0
        assert len(r["f1_histogram"]) == 19
        assert sum(h["n_users"] for h in r["f1_histogram"]) == 100
        assert 0.0 <= r["best_threshold"]["threshold"] <= 1.0
    assert [x["feature"] for x in out["importance"]][:1] in (["a"], ["b"], ["c"])
