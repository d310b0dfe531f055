"""Fixture adapter on a hand-made TPC-H-shaped input: same-day orders,
duplicate brands in one order, pending last orders."""

import datetime as dt

import pytest

from cartwise.sources.adapter import tpch_order_history


@pytest.fixture(scope="module")
def tpch_dir(spark, tmp_path_factory):
    d = tmp_path_factory.mktemp("tpch")
    day = dt.datetime
    orders = [  # key, cust, date, status
        (10, 1, day(2020, 1, 1), "F"),
        (11, 1, day(2020, 1, 3), "F"),
        (12, 1, day(2020, 1, 3), "O"),   # same day as 11: numbered after it by key
        (13, 1, day(2020, 1, 10), "O"),  # last order -> newest ("train")
        (20, 2, day(2020, 2, 1), "F"),
        (21, 2, day(2020, 2, 5), "P"),   # pending last order -> hidden ("test")
        (30, 3, day(2020, 3, 1), "F"),   # no lines -> dropped
    ]
    spark.createDataFrame(orders, "o_orderkey long, o_custkey long, o_orderdate timestamp_ntz, "
                                  "o_orderstatus string").write.parquet(str(d / "orders.parquet"))
    lineitem = [  # order, part, line number
        (10, 100, 1), (10, 101, 2), (10, 102, 3),  # parts 100 and 102 share brand 1
        (11, 101, 1), (12, 100, 1), (13, 101, 1), (13, 100, 2),
        (20, 100, 1), (21, 101, 1),
    ]
    spark.createDataFrame(lineitem, "l_orderkey long, l_partkey long, l_linenumber int") \
        .write.parquet(str(d / "lineitem.parquet"))
    part = [(100, "Brand#1"), (101, "Brand#2"), (102, "Brand#1")]
    spark.createDataFrame(part, "p_partkey long, p_brand string") \
        .write.parquet(str(d / "part.parquet"))
    return str(d)


def test_order_numbering_and_gaps(spark, tpch_dir):
    orders, _ = tpch_order_history(spark, tpch_dir)
    got = {r.order_id: (r.user_id, r.order_number, r.days_since_prior_order, r.eval_set)
           for r in orders.collect()}
    assert got == {
        10: (1, 1, None, "prior"),
        11: (1, 2, 2, "prior"),
        12: (1, 3, 0, "prior"),
        13: (1, 4, 7, "train"),
        20: (2, 1, None, "prior"),
        21: (2, 2, 4, "test"),
    }


def test_lines_dedupe_brand_and_renumber_cart(spark, tpch_dir):
    _, lines = tpch_order_history(spark, tpch_dir)
    got = sorted((r.order_id, r.product_id, r.add_to_cart_order) for r in lines.collect())
    # order 10: brand 1 first seen at line 1, brand 2 at line 2
    assert got[:2] == [(10, 1, 1), (10, 2, 2)]
    assert (13, 2, 1) in got and (13, 1, 2) in got
    assert len(got) == 8


def test_part_grain_keeps_parts(spark, tpch_dir):
    _, lines = tpch_order_history(spark, tpch_dir, grain="part")
    got = sorted((r.order_id, r.product_id) for r in lines.where("order_id = 10").collect())
    assert got == [(10, 100), (10, 101), (10, 102)]
