"""Tasks on raw lines are sized by rows, not by what their shuffle compresses to."""

import re

from pyspark.sql import functions as F

from cartwise import session
from cartwise.operators import features as fx
from cartwise.operators.basket import Basket
from cartwise.sources import history
from cartwise.sources.adapter import tpch_lines, tpch_orders

SF = "/root/testdata/sf0.001"


def _rows(df):
    # sums of doubles differ in the last place with the order of their rows
    return sorted((tuple(round(v, 9) if isinstance(v, float) else v for v in r)
                   for r in df.collect()), key=str)


def _by_number(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return [int(n) for n in re.findall(r"hashpartitioning\([^()]*, (\d+)\), REPARTITION_BY_NUM", plan)]


def test_few_rows_are_left_to_the_session(spark):
    df = spark.range(1000)
    assert session.spread(df, 1000, "id") is df


def test_partitions_grow_with_the_rows(spark, monkeypatch):
    monkeypatch.setattr(session, "TASK_ROWS", 100)
    for rows in (2_000, 20_000):
        sizes = (session.spread(spark.range(rows), rows, "id")
                 .groupBy(F.spark_partition_id()).count().collect())
        assert max(r["count"] for r in sizes) < 200


def test_pairs_and_history_are_the_same_in_tasks_of_few_rows(spark, monkeypatch):
    orders, lines = history.order_history(spark, SF)
    wanted = [fx.top_products(Basket.from_history(orders, lines)),
              fx.feature_matrix(Basket.from_history(orders, lines)), lines, orders]
    wanted = [_rows(df) for df in wanted]
    monkeypatch.setattr(session, "TASK_ROWS", 50)
    pairs = Basket.from_history(orders, lines).pair_rows("counts")
    assert _by_number(pairs) and min(_by_number(pairs)) >= lines.count() // 50
    base = tpch_lines(spark, SF)
    assert _by_number(base) and _by_number(tpch_orders(spark, SF, base))
    header = tpch_orders(spark, SF, base)
    got = [fx.top_products(Basket.from_history(orders, lines)),
           fx.feature_matrix(Basket.from_history(orders, lines)),
           base.join(header.select("order_id", "eval_set"), "order_id").select(*lines.columns),
           header.select(*orders.columns)]
    assert [_rows(df) for df in got] == wanted


def test_orders_meet_their_lines_in_tasks_of_few_rows(spark, monkeypatch):
    base = tpch_lines(spark, SF)
    wanted = _rows(tpch_orders(spark, SF, base))
    monkeypatch.setattr(session, "TASK_ROWS", 50)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        header = tpch_orders(spark, SF, base)
        plan = header._jdf.queryExecution().executedPlan().toString()
        # adaptive execution may merge what it dealt itself, so nothing is dealt by it here
        assert not re.findall(r"hashpartitioning\(o_orderkey[^()]*\), ENSURE_REQUIREMENTS", plan)
        assert re.findall(r"hashpartitioning\(o_orderkey[^()]*\), REPARTITION_BY_NUM", plan)
        assert _rows(header) == wanted
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_an_order_given_twice_or_without_lines(spark, tmp_path, monkeypatch):
    from datetime import datetime

    day = datetime(2020, 1, 2)
    orders = [(1, 7, day, "F"), (1, 7, day, "F"), (2, 7, day, "F"), (None, 7, day, "F"), (3, None, day, "F")]
    spark.createDataFrame(orders, "o_orderkey long, o_custkey long, o_orderdate timestamp, o_orderstatus string"
                          ).write.parquet(f"{tmp_path}/orders.parquet")
    lines = spark.createDataFrame([(1, 4), (1, 5), (3, 4), (None, 4)], "order_id long, product_id long")
    for rows in (500_000, 1):
        monkeypatch.setattr(session, "TASK_ROWS", rows)
        got = tpch_orders(spark, str(tmp_path), lines).select("order_id", "order_number").collect()
        assert sorted(map(tuple, got)) == [(1, 1), (1, 2)]
