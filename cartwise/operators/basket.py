"""Shared intermediates of the feature computation.

A ``Basket`` holds raw order lines (order, product, position) and order headers
with their cart size, and derives the frames every feature is read from:

``orders``        one row per order: header, cart size, ``is_newest``
``newest_users``  one row per user with a newest order: N, G, its cart and time
``timeline``      prior orders + running gap sums (days since first order,
                  days to the newest order) + the user's N and G
``pairs(level)``  one row per (user, product) over all prior lines, with the
                  label ``in_cart``; ``level`` says how much it carries
``users``         per-user statistics of users with a newest order
``products``      per-product statistics over *all* prior users

Everything at line level is keyed on ``order_id``.  From an order history the
line table is scanned twice: once for cart sizes (aggregated by order before the
shuffle) and once for the pairs.  For the pairs, raw lines are shuffled by
``order_id`` to meet the order's values; an order belongs to one user, so the
(user, product, order) grouping reuses that partitioning, and one partially
aggregated shuffle by (user, product) follows.  Prior and newest orders take the
same path, a newest order only setting the label.  Within a (user, product) the
lag-based "between" means telescope to first/last values, so no window over line
rows is needed.

Levels of ``pairs``: ``counts`` needs no order values, ``orders`` needs header,
cart size and N, ``full`` needs the timeline's running sums as well.  A query
builds only what its columns need.

Frames that several consumers read are written once under the shared checkpoint
folder (``materialize``); small sides of joins with popular products or active
users are written too, so that each side of such a join is a plain shuffle that
adaptive execution can split.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwise.functions.expr import cart_percentile_sum, hour_of_week
from cartwise.operators.sequence import DEFAULT_BLOCK, running_sums
from cartwise.session import delete_path, scratch_path, spread
from cartwise.sources.readers import history_header, history_lines

# Fixed value: "last five orders" means order_number >= N - 5.
LAST_N_ORDERS = 5

LEVELS = ("counts", "orders", "full")
_HEADER = ("order_number", "days_since_prior_order", "order_dow", "order_hour_of_day")


class Basket:
    """From two joined line tables (each line with its order's header); see
    :meth:`from_history` for an orders table and a lines table."""

    def __init__(self, prior: DataFrame, newest: DataFrame, block_size: int = DEFAULT_BLOCK,
                 materialize: bool = True):
        def rows(df: DataFrame, is_newest: bool) -> DataFrame:
            # header columns are constant in an order, so ``max`` picks that value
            return df.groupBy("order_id", "user_id").agg(
                *[F.max(c).alias(c) for c in _HEADER],
                F.max("add_to_cart_order").alias("cart_size"),
            ).withColumn("is_newest", F.lit(is_newest))

        body = ["order_id", "product_id", "add_to_cart_order"]
        headers = rows(prior, False).unionByName(rows(newest, True))
        lines = prior.select(*body).unionByName(newest.select(*body))
        self._init(headers, headers, lines, lines, block_size, materialize)

    @classmethod
    def from_history(cls, orders: DataFrame, lines: DataFrame, user_limit: int | None = None,
                     block_size: int = DEFAULT_BLOCK, materialize: bool = True) -> Basket:
        """From an orders header (one row per order, with ``eval_set``) and lines."""
        self = cls.__new__(cls)
        header = history_header(orders, user_limit)
        body = history_lines(lines)
        carts = body.groupBy("order_id").agg(F.max("add_to_cart_order").alias("cart_size"))
        dealt = spread(header, orders.count(), "order_id")
        self._init(header, dealt.join(carts, "order_id"), body, lines, block_size, materialize)
        return self

    def _init(self, keys, headers, lines, counted, block_size, materialize) -> None:
        self._keys = keys.select("order_id", "user_id", "is_newest")
        self._headers = headers
        self._lines = lines
        self._counted = counted  # the lines as they are stored: files know their number of rows
        self.block_size = block_size
        self.materialize = materialize
        self._staged: list[str] = []
        self._pairs: dict[str, DataFrame] = {}
        self.staged_plans: dict[str, str] = {}

    # ---- written tables ------------------------------------------------
    def _stage(self, df: DataFrame, name: str) -> DataFrame:
        if not self.materialize:
            return df
        spark = df.sparkSession
        path = scratch_path(spark, name)
        self.staged_plans[name] = df._jdf.queryExecution().executedPlan().toString()
        df.write.parquet(path)
        self._staged.append(path)
        return spark.read.schema(df.schema).parquet(path)

    def release(self) -> None:
        """Delete the staged tables.  Call only after every frame derived
        from this basket has been written or collected."""
        for path in self._staged:
            delete_path(self._lines.sparkSession, path)
        self._staged.clear()

    @cached_property
    def n_lines(self) -> int:
        """Rows of the line table given, some of which may not be read."""
        return self._counted.count()

    # ---- order level -------------------------------------------------
    @cached_property
    def orders(self) -> DataFrame:
        """One row per order with at least one line."""
        return self._stage(self._headers.select("order_id", "user_id", *_HEADER, "cart_size",
                                                "is_newest"), "orders")

    @property
    def prior_orders(self) -> DataFrame:
        return self.orders.where(~F.col("is_newest")).drop("is_newest")

    @cached_property
    def newest_users(self) -> DataFrame:
        return self._stage(self.orders.where("is_newest").groupBy("user_id").agg(
            F.max("order_number").alias("newest_order_number"),
            F.max("days_since_prior_order").alias("newest_gap"),
            F.max("cart_size").alias("newest_cart_size"),
            hour_of_week(F.max("order_dow"), F.max("order_hour_of_day"))
            .alias("newest_hour_of_week"),
        ), "newest-users")

    @cached_property
    def timeline(self) -> DataFrame:
        """Prior orders + ``days_since_first_order`` (gaps of orders up to and
        including this one) + ``days_to_newest_prior`` (gaps of this and all
        later prior orders) + the user's newest order number and gap."""
        newest = self.newest_users.select("user_id", "newest_order_number", "newest_gap")
        t = running_sums(
            self.prior_orders, ["user_id"], "order_number", "days_since_prior_order",
            forward="days_since_first_order", backward="days_to_newest_prior",
            block_size=self.block_size, per_group=newest,
        )
        return self._stage(t, "timeline")

    def _order_values(self, level: str) -> DataFrame:
        """Per order, what the pair aggregation needs at ``level``; a newest
        order has no values but ``is_newest``."""
        if level == "counts":
            return self._keys
        how = hour_of_week("order_dow", "order_hour_of_day").alias("how")
        recent = (F.col("order_number") >= F.col("newest_order_number") - LAST_N_ORDERS)
        columns = ["order_id", "user_id", F.lit(False).alias("is_newest"), "order_number",
                   "cart_size", how, recent.alias("recent")]
        if level == "full":
            prior = self.timeline.select(
                *columns, F.col("days_since_first_order").alias("dfirst"),
                # days from this order to the newest one; the order's own gap is
                # included (as in the reference definition)
                (F.col("days_to_newest_prior") + F.col("newest_gap")).alias("dnewest"))
        else:
            newest = self.newest_users.select("user_id", "newest_order_number")
            prior = self.prior_orders.join(newest, "user_id", "left").select(*columns)
        hits = self.orders.where("is_newest").select("order_id", "user_id", "is_newest")
        return prior.unionByName(hits, allowMissingColumns=True)

    # ---- (user, product) level ---------------------------------------
    def pair_rows(self, level: str) -> DataFrame:
        """The plan of ``pairs(level)``, newest-only pairs included."""
        # tasks of a bounded number of lines; an order is small
        lines = spread(self._lines, self.n_lines, "order_id")
        joined = lines.join(self._order_values(level), "order_id")
        # the order_id partitioning of the join satisfies this grouping; it makes
        # distinct-order counts exact even if a product repeats within an order
        values = {"orders": ["order_number", "cart_size", "how", "recent"],
                  "full": ["order_number", "cart_size", "how", "recent", "dfirst", "dnewest"]}
        per_order = joined.groupBy("user_id", "product_id", "order_id").agg(
            F.max("is_newest").alias("newest"),
            F.count(F.lit(1)).alias("mult"),
            F.sum("add_to_cart_order").alias("sumpos"),
            *[F.max(c).alias(c) for c in values.get(level, [])],
        )
        prior = ~F.col("newest")
        mult = F.when(prior, F.col("mult"))
        out = [
            F.count(F.when(prior, 1)).alias("n_orders"),
            F.sum(mult).alias("n_lines"),
            F.max(F.col("newest").cast("int")).alias("in_cart"),
        ]
        if level != "counts":
            onum, cart = F.when(prior, F.col("order_number")), F.col("cart_size")
            out += [
                F.min(onum).alias("first_onum"),
                F.max(onum).alias("last_onum"),
                F.sum(F.when(F.col("recent"), mult)).alias("recent_lines"),
                F.sum(mult * cart).alias("sum_cart"),
                F.sum(F.when(prior, cart_percentile_sum("mult", "sumpos", "cart_size"))).alias("sum_pct"),
                F.sum(mult * F.col("how")).alias("sum_how"),
            ]
        if level == "full":
            onum = F.when(prior, F.col("order_number"))
            out += [pick(value, onum).alias(f"{value}_{name}") for value in ("dfirst", "dnewest")
                    for name, pick in (("first", F.min_by), ("last", F.max_by))]
        return per_order.groupBy("user_id", "product_id").agg(*out)

    def pairs(self, level: str = "full") -> DataFrame:
        """Pairs with a prior line, at ``level`` or a fuller one already built."""
        for have in LEVELS[LEVELS.index(level):]:
            if have in self._pairs:
                break
        else:
            have = level
            self._pairs[level] = self._stage(self.pair_rows(level), f"pairs-{level}")
        # pairs seen only in a newest order are no candidates and no history
        return self._pairs[have].where(F.col("n_orders") > 0)

    # ---- user / product level ----------------------------------------
    @property
    def buyers(self) -> DataFrame:
        """Users with a newest order, from the pairs alone."""
        self.pairs("counts")
        fullest = [self._pairs[x] for x in LEVELS if x in self._pairs][0]
        return self._stage(fullest.where("in_cart = 1").select("user_id").distinct(), "buyers")

    @property
    def user_orders(self) -> DataFrame:
        return self.prior_orders.groupBy("user_id").agg(
            F.count(F.lit(1)).alias("total_user_orders"),
            F.max("order_number").alias("last_prior_order"),
        )

    def user_lines(self, level: str) -> DataFrame:
        return self.pairs(level).groupBy("user_id").agg(
            F.count(F.lit(1)).alias("n_products"),
            F.sum("n_lines").alias("n_user_lines"),
        )

    def users(self, level: str, order_columns: bool, line_columns: bool) -> DataFrame:
        """Users with a newest order and the statistics asked for, written."""
        out = self.newest_users if order_columns else self.buyers
        if order_columns:
            out = out.join(self.user_orders, "user_id")
        if line_columns:
            out = out.join(self.user_lines(level), "user_id")
        return self._stage(out, "users")

    @cached_property
    def total_orders(self):
        """Scalar subquery: number of distinct prior orders (all users)."""
        return self.prior_orders.agg(F.count(F.lit(1))).scalar()

    @staticmethod
    def product_statistics(pairs: DataFrame) -> DataFrame:
        """Per-product statistics over every prior user (never only the
        candidates' users).  An order belongs to one user, so summing the
        pairs' distinct-order counts gives distinct orders per product."""
        return pairs.groupBy("product_id").agg(
            F.sum("n_orders").alias("count_in_all_orders"),
            F.count(F.lit(1)).alias("n_users"),
            F.sum("n_lines").alias("n_product_lines"),
        )

    def products(self, level: str = "counts") -> DataFrame:
        return self._stage(self.product_statistics(self.pairs(level)), "products")
