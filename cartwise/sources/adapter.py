"""Fixture adapter: TPC-H-style tables -> order history.

The test tables are a star schema (``orders``, ``lineitem``, ``part``), not
basket data, so they are mapped onto the order-history model:

* product  = the brand of the part (digits of ``p_brand``), or with
             ``grain="part"`` the part itself (high cardinality, few repeats);
* lines    = one row per (order, product), ``add_to_cart_order`` re-derived
             from the first line number, so positions are 1..cart size;
* user     = customer; ``order_number`` = position of the order in the
             customer's history by (date, key); ``days_since_prior_order`` =
             days since the previous order (null for the first);
* hour     = ``o_orderkey % 24`` (the dates carry no time of day);
* eval_set = ``prior`` for every order but a customer's last; the last order
             is ``train`` (its basket is the label) unless it is still
             pending (``o_orderstatus = 'P'``), then ``test`` (basket hidden).

Numbering a customer's orders is a running count.  It is computed in two
levels so that a customer with a huge history is not sorted in one task:
per (customer, day) block a row number, and per customer a running count over
its day blocks (at most one row per calendar day).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cartwise.session import spread
from cartwise.sources.tables import read_table


def _product(grain: str):
    if grain == "brand":
        return F.regexp_extract("p_brand", "[0-9]+", 0).cast("long")
    if grain == "part":
        return F.col("p_partkey").cast("long")
    raise ValueError(f"unknown product grain: {grain}")


def tpch_lines(spark: SparkSession, sf_dir: str, grain: str = "brand") -> DataFrame:
    """order_id, product_id, add_to_cart_order (one row per order, product)."""
    lineitem = read_table(spark, sf_dir, "lineitem",
                          ["l_orderkey", "l_partkey", "l_linenumber"])
    part = read_table(spark, sf_dir, "part", ["p_partkey", "p_brand"])
    brand = _product(grain)
    bought = (
        lineitem.where(F.col("l_orderkey").isNotNull() & F.col("l_partkey").isNotNull())
        .join(part.select("p_partkey", brand.alias("product_id")),
              F.col("l_partkey") == F.col("p_partkey"))
        .select(F.col("l_orderkey").alias("order_id"), "product_id", "l_linenumber")
    )
    # by order: serves the grouping and the window below
    firsts = (spread(bought, lineitem.count(), "order_id").groupBy("order_id", "product_id")
              .agg(F.min("l_linenumber").alias("ln")))
    # A cart holds at most one row per product and an order has few lines
    # (at most 7 in TPC-H), so this window is bounded.
    w = Window.partitionBy("order_id").orderBy("ln", "product_id")
    return firsts.select(
        "order_id", "product_id",
        F.row_number().over(w).cast("int").alias("add_to_cart_order"),
    )


def tpch_orders(spark: SparkSession, sf_dir: str, lines: DataFrame) -> DataFrame:
    """Order header with order_number, gaps and eval_set."""
    orders = read_table(spark, sf_dir, "orders",
                        ["o_orderkey", "o_custkey", "o_orderdate", "o_orderstatus"])
    n_orders, n_lines = orders.count(), lines.count()
    # both sides dealt alike, as one left to the session has both dealt anew, by bytes; an
    # inner join with distinct ids, as a semi join is pushed below the dealing of its rows
    with_lines = spread(lines.select(F.col("order_id").alias("o_orderkey")),
                        n_lines, "o_orderkey").distinct()
    kept = (
        spread(orders.where(F.col("o_orderkey").isNotNull() & F.col("o_custkey").isNotNull()),
               n_lines, "o_orderkey")
        .join(with_lines, "o_orderkey")
        .withColumn("day", F.to_date("o_orderdate"))
    )
    kept = spread(kept, n_orders, "o_custkey", "day")
    in_day = Window.partitionBy("o_custkey", "day").orderBy("o_orderdate", "o_orderkey")
    numbered = kept.withColumn("rn", F.row_number().over(in_day))

    days = kept.groupBy("o_custkey", "day").agg(F.count(F.lit(1)).alias("cnt"))
    by_day = Window.partitionBy("o_custkey").orderBy("day")
    days = days.select(
        "o_custkey", "day",
        F.coalesce(F.sum("cnt").over(by_day.rowsBetween(Window.unboundedPreceding, -1)),
                   F.lit(0)).alias("before"),
        F.lag("day").over(by_day).alias("prev_day"),
        F.sum("cnt").over(by_day.rowsBetween(Window.unboundedPreceding,
                                             Window.unboundedFollowing)).alias("total"),
    )
    seq = numbered.join(days, ["o_custkey", "day"])
    order_number = (F.col("before") + F.col("rn")).cast("int")
    prev_day = F.when(F.col("rn") == 1, F.col("prev_day")).otherwise(F.col("day"))
    last = order_number == F.col("total")
    eval_set = (F.when(~last, F.lit("prior"))
                .when(F.col("o_orderstatus") == "P", F.lit("test"))
                .otherwise(F.lit("train")))
    return seq.select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("user_id"),
        order_number.alias("order_number"),
        (F.dayofweek("day") - 1).cast("int").alias("order_dow"),
        (F.col("o_orderkey") % 24).cast("int").alias("order_hour_of_day"),
        F.datediff("day", prev_day).cast("int").alias("days_since_prior_order"),
        eval_set.alias("eval_set"),
    )


def tpch_order_history(spark: SparkSession, sf_dir: str,
                       grain: str = "brand") -> tuple[DataFrame, DataFrame]:
    """(orders header, order lines) in the order-history model."""
    lines = tpch_lines(spark, sf_dir, grain)
    return tpch_orders(spark, sf_dir, lines), lines


def tpch_products(spark: SparkSession, sf_dir: str, grain: str = "brand") -> DataFrame:
    """Product dimension: one row per brand (or per part)."""
    if grain == "part":
        part = read_table(spark, sf_dir, "part", ["p_partkey", "p_name"])
        return part.where(F.col("p_partkey").isNotNull()).select(
            F.col("p_partkey").cast("long").alias("product_id"),
            F.col("p_name").alias("product_name"))
    part = read_table(spark, sf_dir, "part", ["p_brand"])
    return (part.where(F.col("p_brand").isNotNull())
            .groupBy(_product("brand").alias("product_id"))
            .agg(F.min("p_brand").alias("product_name")))


def tpch_product_attributes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Product dimension with aisle and department, one row per brand; names hold a
    comma and quotes, as those of a real catalogue may."""
    part = read_table(spark, sf_dir, "part", ["p_brand", "p_name", "p_size", "p_type"])
    name = F.concat(F.min("p_brand"), F.lit(', "'), F.min("p_name"), F.lit('"'))
    return (part.where(F.col("p_brand").isNotNull())
            .groupBy(_product("brand").alias("product_id"))
            .agg(name.alias("product_name"), F.min("p_size").cast("int").alias("aisle_id"),
                 F.count_distinct("p_type").cast("int").alias("department_id")))
