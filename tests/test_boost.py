"""Boosted trees grown over a round's sample: Spark ML's trees, and no round twice."""

import re

import numpy as np
import pytest
from pyspark.ml.classification import GBTClassifier
from pyspark.sql import functions as F

from cartwise.models import boost
from cartwise.models import train as tr
from cartwise.models.expressions import parsed_trees

FEATS = ["a", "b", "c", "d"]


@pytest.fixture(scope="module")
def data(spark, tmp_path_factory):
    rng = np.random.default_rng(3)
    n = 6000
    x = rng.uniform(size=(n, 4))
    y = (rng.uniform(size=n) < 1 / (1 + np.exp(-(6 * np.abs(x[:, 0] - 0.5) - 3 * x[:, 1] + x[:, 2])))).astype(int)
    rows = [(i // 6, int(y[i]), *map(float, x[i])) for i in range(n)]
    path = str(tmp_path_factory.mktemp("boost") / "rows")
    df = spark.createDataFrame(rows, "user_id long, in_cart int, a double, b double, c double, d double")
    df.repartition(3).write.parquet(path)
    return spark.read.parquet(path)


def _plain(est):
    """Spark ML's own estimator with the same parameters."""
    return GBTClassifier()._set(**{p.name: v for p, v in est.extractParamMap().items()})


def test_random_numbers_are_sparks(spark):
    jvm = spark._jvm
    java = jvm.org.apache.spark.util.random.XORShiftRandom(77)
    draws = np.array([java.nextDouble() for _ in range(1500)])
    states = np.array([boost.hash_seed(77), boost.hash_seed(-5)], dtype=np.uint64)
    assert (boost.drawn(states, 0, 1500, 0.08)[0] == (draws < 0.08)).all()
    assert (boost.drawn(states, 700, 300, 0.4)[0] == (draws[700:1000] < 0.4)).all()
    assert boost.drawn(states, 9, 4, 1.0).all()
    java, longs = jvm.java.util.Random(29), boost.java_longs(29)
    assert [java.nextLong() for _ in range(8)] == [next(longs) for _ in range(8)]


@pytest.mark.parametrize("rate", [0.5, 1.0])
def test_trees_are_those_of_spark_ml(data, rate, monkeypatch):
    monkeypatch.setattr(boost, "BLOCK_ROWS", 500)  # several blocks a task, and 20 rounds: two passes
    est = tr.gbt_estimator(20).setSubsamplingRate(rate)
    rows = tr._labelled(data, "in_cart")
    ours = tr._pipeline(est, FEATS).fit(rows)
    theirs = tr._pipeline(_plain(est), FEATS).fit(rows)
    a, b = ours.stages[-1], theirs.stages[-1]
    splits = lambda m: re.sub(r"Predict: .*|uid ?= ?\w+", "", m.toDebugString)
    assert splits(a) == splits(b)
    assert a.treeWeights == b.treeWeights and \
        {p.name for p in a.extractParamMap()} == {p.name for p in b.extractParamMap()}
    assert a.featureImportances.toArray() == pytest.approx(b.featureImportances.toArray(), abs=1e-9)
    assert [t.numNodes for t in a.trees] == [t.numNodes for t in b.trees]
    scores = [m.transform(data).select("user_id", "a", F.col("rawPrediction")).collect() for m in (ours, theirs)]
    assert [r.rawPrediction[1] for r in scores[0]] == pytest.approx(
        [r.rawPrediction[1] for r in scores[1]], abs=1e-9)


def test_more_rounds_go_on_from_those_there_are(data, monkeypatch):
    grown, begun = [], []
    one, new = boost.Booster._grown, boost.Booster.__init__
    monkeypatch.setattr(boost.Booster, "_grown", lambda self: grown.append(1) or one(self))
    monkeypatch.setattr(boost.Booster, "__init__", lambda self, *a: begun.append(1) or new(self, *a))
    seen = []

    def scores(model, *_):
        seen.append([root for _, root in parsed_trees(model)])
        return [1 - abs(i - 9) / 100 for i in range(len(seen[-1]))]

    monkeypatch.setattr(tr, "auc_by_round", scores)
    assert tr.boosting_rounds(data, data, FEATS, patience=3, first=5, most=40) == 10
    assert [len(s) for s in seen] == [5, 10, 20] and seen[1][:5] == seen[0] and seen[2][:10] == seen[1]
    assert len(begun) == 1 and len(grown) == 20  # and not 35


def test_samples_nobody_is_in_and_labels_of_one_kind(spark):
    few = spark.createDataFrame([(0.0, 1, 0.5), (1.0, 2, 0.7)], "in_cart double, user_id long, a double")
    model = tr._pipeline(tr.gbt_estimator(3), ["a"]).fit(few).stages[-1]
    assert [t.numNodes for t in model.trees] == [1, 1, 1]
    same = spark.range(400).select(F.lit(1.0).alias("in_cart"), (F.col("id") / 400).alias("a"))
    model = tr._pipeline(tr.gbt_estimator(2).setSubsamplingRate(1.0), ["a"]).fit(same)
    assert model.transform(same).where("prediction = 1").count() == 400


def test_labels_other_than_0_and_1_and_nulls_are_errors(spark):
    for rows in ([(2.0, 0.1), (0.0, 0.2)], [(None, 0.1), (0.0, 0.2)], [(1.0, None), (0.0, 0.2)]):
        df = spark.createDataFrame(rows, "in_cart double, a double")
        with pytest.raises(Exception, match="(?i)label|null|assembl"):
            tr._pipeline(tr.gbt_estimator(2), ["a"]).fit(df)
