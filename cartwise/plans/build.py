"""Training job.

orders + lines -> (prior, newest) -> feature matrix (written once to the
shared checkpoint folder: the ML stages iterate over it, and the written
table cuts the lineage) -> group split -> min-max scaling fitted on train ->
logistic regression and gradient-boosted trees -> saved test set and models, in a
fresh folder, published by a manifest once all of them are there (see
``sources.artefacts``).
"""

from __future__ import annotations

import os
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession

from cartwise.models.train import fit_gbt, fit_logistic_regression
from cartwise.operators.basket import Basket
from cartwise.operators.features import feature_matrix
from cartwise.operators.scale import MinMaxModel, fit_min_max
from cartwise.operators.split import train_test_by_group
from cartwise.schema import FEATURES, ID_COL, ITEM_COL, LABEL_COL
from cartwise.session import scratch_path
from cartwise.sources.artefacts import ArtefactStore
from cartwise.sources.sinks import load_model, save_model, try_read_table, write_table

# Fixed values of the reference split.
TEST_SIZE = 0.1
SPLIT_SEED = 29


@dataclass
class BuildResult:
    train: DataFrame
    test: DataFrame
    lr: PipelineModel
    gbt: PipelineModel
    scaler: MinMaxModel | None = None


def materialise(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` under the shared checkpoint folder and read it back."""
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def build_feature_matrix(spark: SparkSession, orders: DataFrame, lines: DataFrame,
                         user_limit: int | None = None,
                         drop_newest_cart: bool = False) -> DataFrame:
    basket = Basket.from_history(orders, lines, user_limit)
    m = materialise(spark, feature_matrix(basket, drop_newest_cart=drop_newest_cart),
                    "feature-matrix")
    basket.release()  # the written matrix no longer needs the staged tables
    return m


def split_and_scale(matrix: DataFrame, features: list[str] = FEATURES,
                    test_size: float = TEST_SIZE, seed: int | None = SPLIT_SEED):
    cols = [ID_COL, ITEM_COL, LABEL_COL, *features]
    # both sides are filters on the scan of the written matrix
    train_raw, test_raw = train_test_by_group(matrix.select(*cols), ID_COL, test_size, seed)
    scaler = fit_min_max(train_raw, features)
    return scaler.transform(train_raw), scaler.transform(test_raw), scaler


def build_models(spark: SparkSession, orders: DataFrame, lines: DataFrame,
                 out_dir: str | None = None, user_limit: int | None = None,
                 gbt_iter: int | None = None, drop_newest_cart: bool = False) -> BuildResult:
    matrix = build_feature_matrix(spark, orders, lines, user_limit, drop_newest_cart)
    return train_from_matrix(spark, matrix, out_dir, gbt_iter, drop_newest_cart)


def train_from_matrix(spark: SparkSession, matrix: DataFrame, out_dir: str | None = None,
                      gbt_iter: int | None = None, drop_newest_cart: bool = False) -> BuildResult:
    """Split, scale, fit both models (and save them) from a built matrix."""
    features = [f for f in FEATURES
                if not (drop_newest_cart and f in ("newest_cart_size", "cart_size_difference"))]
    train, test, scaler = split_and_scale(matrix, features)
    # the fits iterate over the scaled rows: write both sides once
    train = materialise(spark, train, "train-set")
    test = materialise(spark, test, "test-set")
    n_train = train.count()
    lr = fit_logistic_regression(train, features, n_train=n_train)
    gbt = fit_gbt(train, features, max_iter=gbt_iter)
    if out_dir:
        with ArtefactStore(spark, out_dir).begin() as run:
            write_table(test, run.part("test_set"))
            for name, model in (("model_lr", lr), ("model_gbt", gbt)):
                path = run.part(name)
                if not save_model(model, path):
                    raise OSError(f"model could not be saved to {path}")
            run.publish()
    return BuildResult(train, test, lr, gbt, scaler)


def load_saved(spark: SparkSession, out_dir: str) -> BuildResult | None:
    """The newest published test set and models that can all be read, from one and the
    same manifest; without manifests, what lies in ``out_dir`` itself."""
    store = ArtefactStore(spark, out_dir)
    sets = [[store.path(m, name) for name in ("test_set", "model_lr", "model_gbt")]
            for m in store.manifests()]
    if not sets:
        sets = [[os.path.join(out_dir, name) for name in ("test_set", "model_lr", "model_gbt")]]
    for paths in sets:
        if None in paths:
            continue
        test = try_read_table(spark, paths[0])
        lr, gbt = (load_model(p) for p in paths[1:])
        if test is not None and lr is not None and gbt is not None:
            return BuildResult(None, test, lr, gbt)
    return None


def load_or_build(spark: SparkSession, out_dir: str, build, force_rebuild: bool = False
                  ) -> BuildResult:
    """Reuse the saved test set and models; rebuild (``build()``, which must
    save into ``out_dir``) when asked to or when any of them is missing or
    unreadable."""
    saved = None if force_rebuild else load_saved(spark, out_dir)
    return build() if saved is None else saved
