"""What decides cost at scale: line scans, exchanges, skew, scratch tables."""

import re

import pytest
from pyspark.sql import functions as F

from cartwise.operators import features as fx
from cartwise.operators import split as sp
from cartwise.operators.basket import Basket
from cartwise.operators.scale import fit_min_max
from cartwise.session import cluster_conf, release_scratch, scratch_path
from cartwise.sources import history

SF = "/root/testdata/sf0.001"
NO_BROADCAST = {"spark.sql.autoBroadcastJoinThreshold": "-1",
                "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}


@pytest.fixture
def conf(spark):
    """Set session values for one test."""
    old = {}

    def put(**values):
        for k, v in values.items():
            old.setdefault(k, spark.conf.get(k, None))
            spark.conf.set(k, v)

    yield lambda values: put(**values)
    for k, v in old.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def line_scans(plan):
    return plan.count("add_to_cart_order:int") if "FileScan" in plan else 0


def raw_line_exchanges(plan):
    """Exchanges that get line rows as they were scanned."""
    lines, found = plan.splitlines(), 0
    for i, text in enumerate(lines):
        if "Exchange hashpartitioning" in text:
            for below in lines[i + 1:]:
                if "Exchange" in below or "HashAggregate" in below or "Join" in below:
                    break
                if "FileScan" in below:
                    found += "add_to_cart_order:int" in below
                    break
    return found


def test_line_table_is_scanned_twice_and_shuffled_once(spark, conf):
    orders, lines = history.order_history(spark, SF)
    conf(NO_BROADCAST)
    b = Basket.from_history(orders, lines)
    final = fx.feature_matrix(b)._jdf.queryExecution().executedPlan().toString()
    plans = [*b.staged_plans.values(), final]
    assert set(b.staged_plans) == {"orders", "newest-users", "timeline", "pairs-full", "users", "products"}
    assert sum(map(line_scans, plans)) == 2
    assert sum(map(raw_line_exchanges, plans)) == 1
    pairs = b.staged_plans["pairs-full"]
    # lines and order values meet on order_id; then one partially aggregated shuffle
    assert len(re.findall(r"Exchange hashpartitioning\(user_id", pairs)) == 1
    assert "partial_count" in pairs
    b.release()


def test_narrow_queries_stage_no_timeline(spark):
    orders, lines = history.order_history(spark, SF)
    for query, staged in ((fx.candidates, {"pairs-counts", "buyers"}), (fx.top_products, set()),
                          (fx.user_proba, {"pairs-counts", "buyers", "users"}),
                          (fx.mean_order, {"orders", "newest-users", "pairs-orders", "users"})):
        b = Basket.from_history(orders, lines)
        assert query(b).count() > 0
        assert set(b.staged_plans) == staged
        b.release()


def _skewed(spark, hot_user: bool):
    """Many users and products; half of all pairs hold one product (or one user)."""
    n = 6000
    rows = spark.range(n).select(
        F.col("id").alias("order_id"),
        (F.when(F.col("id") % 2 == 0, F.lit(0)).otherwise(F.col("id")) if hot_user else F.col("id") % 3000)
        .cast("long").alias("user_id"),
        (F.col("id") if hot_user else F.when(F.col("id") % 2 == 0, F.lit(0)).otherwise(F.col("id")))
        .cast("long").alias("product_id"),
        F.lit(1).alias("add_to_cart_order"), (F.col("id") / 3000 + 1).cast("int").alias("order_number"),
        F.lit(1).alias("order_dow"), F.lit(2).alias("order_hour_of_day"), F.lit(3).alias("days_since_prior_order"))
    newest = rows.select((F.col("order_id") + n).alias("order_id"), "product_id", "add_to_cart_order",
                         "user_id", F.lit(9).alias("order_number"), "order_dow", "order_hour_of_day",
                         "days_since_prior_order").dropDuplicates(["user_id"])
    return Basket(rows, newest)


@pytest.mark.parametrize("hot_user", [False, True])
def test_hot_products_and_users_are_split(spark, conf, hot_user):
    conf({**NO_BROADCAST, "spark.sql.shuffle.partitions": "12",
          "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2k",
          "spark.sql.adaptive.coalescePartitions.enabled": "false",
          "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "2k",
          "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2"})
    b = _skewed(spark, hot_user)
    out = fx.user_proba(b) if hot_user else fx.product_proba(b)
    out.collect()
    assert "skew=true" in out._jdf.queryExecution().executedPlan().toString()
    b.release()


def test_split_folds_and_scaling_shuffle_nothing(spark, conf):
    conf(NO_BROADCAST)
    m = history.feature_matrix_table(spark, SF)
    train, test = sp.train_test_by_group(m, "user_id", 0.1, 29)
    folded = sp.with_folds(m, "user_id", 5, 29)
    scaled = fit_min_max(train, ["mean_cart_size"]).transform(test)
    for df in (train, test, folded, scaled):
        assert "Exchange" not in df._jdf.queryExecution().executedPlan().toString()
    want = {r.user_id: r.fold for r in sp.group_folds(m, "user_id", 5, 29).collect()}
    got = {(r.user_id, r.fold) for r in folded.select("user_id", "fold").distinct().collect()}
    assert got == set(want.items())
    users = m.select("user_id").distinct().count()
    assert test.select("user_id").distinct().count() == int(users * 0.1)
    assert train.count() + test.count() == m.count() == folded.count()


def test_split_of_few_null_and_no_groups(spark):
    df = spark.createDataFrame([(1, 1), (None, 2), (2, 3), (2, 4)], "user_id long, x int")
    train, test = sp.train_test_by_group(df, "user_id", 0.5, 1)
    assert test.select("user_id").distinct().count() == 1 and train.where("user_id IS NULL").count() == 1
    assert sp.train_test_by_group(df, "user_id", 0.1, 1)[1].count() == 0
    assert {r.fold for r in sp.with_folds(df, "user_id", 5, 1).collect()} == {0, 2}
    assert sp.with_folds(df.limit(0), "user_id", 5, 1).count() == 0


def test_scratch_paths_never_meet(spark, monkeypatch):
    monkeypatch.setattr("os.getpid", lambda: 1)
    a, b = scratch_path(spark, "pairs"), scratch_path(spark, "pairs")
    assert a != b and spark.sparkContext.applicationId in a


def test_no_local_folder_on_a_cluster():
    class Context:
        master = "yarn"
        applicationId = "app"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()

        class conf:
            @staticmethod
            def get(key, default):
                return default

    with pytest.raises(ValueError):
        scratch_path(Session(), "x")


def test_release_scratch_removes_the_applications_tables(spark):
    import os

    path = scratch_path(spark, "gone")
    spark.range(3).write.parquet(path)
    local = re.sub("^file:(//)?", "", path)
    assert os.path.isdir(local)
    release_scratch(spark)
    assert not os.path.exists(os.path.dirname(local))


def test_partition_width_has_no_cap():
    conf = cluster_conf(100 << 40, 4000)
    assert int(conf["spark.sql.shuffle.partitions"]) == (100 << 40) // (256 << 20)
