import pytest
from pyspark.sql import types as T

from cartwise.operators import evaluate as ev
from tests.fixtures import EVAL_ROWS, EXPECTED_USER_F1

SCHEMA = T.StructType([
    T.StructField("user_id", T.LongType()),
    T.StructField("in_cart", T.IntegerType()),
    T.StructField("score", T.DoubleType()),
])


@pytest.fixture(scope="module")
def scores(spark):
    return spark.createDataFrame(EVAL_ROWS, SCHEMA)


def _brute_f1(rows, t):
    tp = sum(1 for _, y, p in rows if p >= t and y == 1)
    fp = sum(1 for _, y, p in rows if p >= t and y == 0)
    fn = sum(1 for _, y, p in rows if p < t and y == 1)
    return 0.0 if 2 * tp + fp + fn == 0 else 2 * tp / (2 * tp + fp + fn), tp, fp, fn


def test_per_user_f1(scores):
    got = {r.user_id: r.f1 for r in ev.per_user_f1(scores, 0.5).collect()}
    assert got == pytest.approx(EXPECTED_USER_F1)


def test_mean_user_f1(scores):
    r = ev.mean_user_f1(ev.per_user_f1(scores, 0.5)).first()
    assert r.n_users == 4 and r.mean_f1 == pytest.approx(sum(EXPECTED_USER_F1.values()) / 4)


def test_overall_metrics(scores):
    r = ev.overall_metrics(scores, 0.5).first()
    f1, tp, fp, fn = _brute_f1(EVAL_ROWS, 0.5)
    assert (r.tp, r.fp, r.fn) == (tp, fp, fn)
    assert r.tn == len(EVAL_ROWS) - tp - fp - fn
    assert r.f1 == pytest.approx(f1)
    assert r.precision == pytest.approx(tp / (tp + fp))
    assert r.recall == pytest.approx(tp / (tp + fn))


def test_threshold_sweep_matches_brute_force(scores):
    rows = {round(r.threshold, 2): r for r in ev.threshold_sweep(scores, 100).collect()}
    assert len(rows) == 101
    for k in range(101):
        t = k / 100
        f1, tp, fp, fn = _brute_f1(EVAL_ROWS, t)
        r = rows[round(t, 2)]
        assert (r.tp, r.fp, r.fn) == (tp, fp, fn), t
        assert r.f1 == pytest.approx(f1)
    best = ev.best_threshold(ev.threshold_sweep(scores, 100)).first()
    assert best.f1 == pytest.approx(max(_brute_f1(EVAL_ROWS, k / 100)[0] for k in range(101)))


def test_histogram_puts_one_in_last_bin(scores):
    h = {r.bin: r.n_users for r in ev.f1_histogram(ev.per_user_f1(scores, 0.5)).collect()}
    assert len(h) == 19 and sum(h.values()) == 4
    assert h[18] == 2 and h[0] == 1 and h[7] == 1  # 0.4 * 19 = 7.6


def test_users_with_f1(scores):
    got = [r.user_id for r in ev.users_with_f1(ev.per_user_f1(scores, 0.5), 1.0).collect()]
    assert got == [2, 4]


def test_threshold_is_inclusive(scores):
    preds = {(r.user_id, r.score): r.prediction
             for r in ev.with_prediction(scores, 0.5).collect()}
    assert preds[(4, 0.5)] == 1
