"""Candidates, label and the eighteen features.

Each public function takes a :class:`Basket` and returns one row per
candidate (user, product) with the columns of one reference feature group;
``feature_matrix`` returns all of them from a single plan.

Candidates are the (user, product) pairs bought in a prior order by users who
also have a newest order.  Product statistics are computed before that
restriction (over all prior users).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartwise.functions.expr import ratio
from cartwise.operators.basket import Basket
from cartwise.schema import FEATURES, FEATURE_TYPES

KEYS = ["user_id", "product_id"]


def candidates(b: Basket) -> DataFrame:
    """user_id, product_id, count_in_user_orders (distinct prior orders)."""
    return (b.pairs("counts").join(b.buyers, "user_id", "left_semi")
            .select(*KEYS, F.col("n_orders").alias("count_in_user_orders")))


def target(b: Basket) -> DataFrame:
    """user_id, product_id, in_cart (product is in the user's newest order);
    the label is computed inside the pair aggregation."""
    return b.pairs("counts").join(b.buyers, "user_id", "left_semi").select(*KEYS, "in_cart")


# ---- feature expressions over the joined candidate frame ------------------

def _expressions() -> dict[str, Column]:
    n_lines = F.col("n_lines")
    first, last = F.col("first_onum"), F.col("last_onum")
    N = F.col("newest_order_number")
    mean_orders_between = F.when(
        N.isNull(), ratio(last - first, F.nullif(n_lines - 1, F.lit(0)))
    ).otherwise(ratio(last - first + (N - first), n_lines))
    d_first, d_last = F.col("dfirst_first"), F.col("dfirst_last")
    dn_first = F.col("dnewest_first")
    mean_days_between = F.when(
        dn_first.isNull(), ratio(d_last - d_first, F.nullif(n_lines - 1, F.lit(0)))
    ).otherwise(ratio(d_last - d_first + dn_first, n_lines))
    mean_cart_size = ratio("sum_cart", "n_lines")
    mean_how = ratio("sum_how", "n_lines")
    return {
        "percent_in_user_orders": ratio("n_orders", "total_user_orders"),
        "percent_in_all_orders": ratio("count_in_all_orders", "_total_orders"),
        "in_last_cart": (last == F.col("last_prior_order")).cast("int"),
        "in_last_five": F.coalesce(F.col("recent_lines"), F.lit(0)),
        "total_user_orders": F.col("total_user_orders"),
        "mean_orders_between": mean_orders_between,
        "mean_days_between": mean_days_between,
        "orders_since_newest": (N - last).cast("int"),
        "days_since_newest": F.col("dnewest_last"),
        "product_reorder_proba": 1.0 - ratio("n_users", "n_product_lines"),
        "user_reorder_proba": 1.0 - ratio("n_products", "n_user_lines"),
        "mean_cart_size": mean_cart_size,
        "mean_cart_percentile": ratio("sum_pct", "n_lines"),
        "mean_hour_of_week": mean_how,
        "newest_cart_size": F.col("newest_cart_size"),
        "newest_hour_of_week": F.col("newest_hour_of_week"),
        "cart_size_difference": F.abs(mean_cart_size - F.col("newest_cart_size")),
        "hour_of_week_difference": F.abs(mean_how - F.col("newest_hour_of_week")),
    }


_NEEDS_PRODUCTS = {"percent_in_all_orders", "product_reorder_proba"}
# what a feature needs beyond (user, product) counts
_COUNTS = {"percent_in_user_orders", "total_user_orders", "percent_in_all_orders",
           "product_reorder_proba", "user_reorder_proba"}
_RUNNING = {"mean_days_between", "days_since_newest"}
_NO_ORDERS = {"product_reorder_proba", "user_reorder_proba"}


def _candidate_frame(b: Basket, names: list[str], label: bool = False) -> DataFrame:
    wanted = set(names)
    level = "full" if wanted & _RUNNING else "counts" if wanted <= _COUNTS else "orders"
    users = b.users(level, order_columns=not wanted <= _NO_ORDERS,
                    line_columns="user_reorder_proba" in wanted)
    # inner join with users that have a newest order = the candidate filter
    df = b.pairs(level).join(users, "user_id")
    if _NEEDS_PRODUCTS & wanted:
        products = b.products(level)
        if "percent_in_all_orders" in wanted:
            products = products.withColumn("_total_orders", b.total_orders)
        df = df.join(products, "product_id")
    exprs = _expressions()
    cols = [exprs[n].cast(FEATURE_TYPES[n]).alias(n) for n in names]
    return df.select(*KEYS, *(["in_cart"] if label else []), *cols)


def rate_by_user(b: Basket) -> DataFrame:
    return _candidate_frame(b, ["total_user_orders", "percent_in_user_orders"])


def rate_overall(b: Basket) -> DataFrame:
    return _candidate_frame(b, ["percent_in_all_orders"])


def in_last_cart(b: Basket) -> DataFrame:
    return _candidate_frame(b, ["in_last_cart"])


def in_last_five(b: Basket) -> DataFrame:
    return _candidate_frame(b, ["in_last_five"])


def reorder_gaps(b: Basket) -> DataFrame:
    return _candidate_frame(b, ["mean_orders_between", "mean_days_between"])


def time_since_order(b: Basket) -> DataFrame:
    return _candidate_frame(b, ["mean_orders_between", "mean_days_between",
                                "orders_since_newest", "days_since_newest",
                                "in_last_five"])


def product_proba(b: Basket) -> DataFrame:
    return _candidate_frame(b, ["product_reorder_proba"])


def user_proba(b: Basket) -> DataFrame:
    return _candidate_frame(b, ["user_reorder_proba"])


def mean_order(b: Basket) -> DataFrame:
    return _candidate_frame(b, ["mean_cart_size", "mean_cart_percentile", "mean_hour_of_week"])


def newest_order(b: Basket) -> DataFrame:
    return _candidate_frame(b, ["newest_cart_size", "newest_hour_of_week",
                                "cart_size_difference", "hour_of_week_difference"])


def feature_matrix(b: Basket, drop_newest_cart: bool = False) -> DataFrame:
    """user_id, product_id, in_cart + the eighteen features.

    ``drop_newest_cart`` removes the two columns that describe the very
    basket being predicted (newest_cart_size, cart_size_difference).
    """
    names = [n for n in FEATURES
             if not (drop_newest_cart and n in ("newest_cart_size", "cart_size_difference"))]
    return _candidate_frame(b, names, label=True)


def order_timeline(b: Basket) -> DataFrame:
    """Per prior order: days since the user's first order and days to the
    newest order (both include the order's own gap)."""
    t = b.timeline
    return t.select(
        "user_id", "order_id", "order_number",
        F.col("days_since_first_order").cast("long").alias("days_since_first_order"),
        (F.col("days_to_newest_prior") + F.col("newest_gap")).cast("long")
        .alias("days_since_newest"),
    )


def top_products(b: Basket, k: int = 10) -> DataFrame:
    """The k products in the most distinct prior orders (ties: lower id)."""
    products = b.product_statistics(b.pair_rows("counts").where(F.col("n_orders") > 0))
    return (products.select("product_id", "count_in_all_orders")
            .orderBy(F.desc("count_in_all_orders"), "product_id").limit(k))
