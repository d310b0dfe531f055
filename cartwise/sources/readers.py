"""Readers for order history.

The engine consumes two *joined* line tables (line + order header):
``prior`` (every earlier order) and ``newest`` (each user's newest order,
whose basket is the label).  They come from an orders header and a line
table joined on ``order_id``; the same function serves parquet, CSV and
JDBC inputs (``sources.jdbc``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartwise.schema import LINE_COLUMNS, PRODUCTS_SCHEMA
from cartwise.sources.sinks import CSV

_HEADER_COLUMNS = ["order_id", "user_id", "order_number", "order_dow",
                   "order_hour_of_day", "days_since_prior_order"]


def apply_user_limit(df: DataFrame, user_limit: int | None) -> DataFrame:
    """Keep users with ``user_id < user_limit``; no-op when <= 0 or None.

    Note the semantics: an id bound, not "the first N users".
    """
    if user_limit is None or user_limit <= 0:
        return df
    return df.where(F.col("user_id") < F.lit(int(user_limit)))


def join_order_header(lines: DataFrame, orders: DataFrame,
                      eval_set: str | Column | None = None,
                      user_limit: int | None = None) -> DataFrame:
    """Inner-join order lines with their order header on ``order_id``.

    ``eval_set`` selects which orders (``prior`` / ``train``) to keep; when
    the line table carries ``eval_set`` too (e.g. stored partitioned by it),
    the same filter prunes the line scan.  Null keys are dropped: they can
    neither group nor join.
    """
    header = orders
    if eval_set is not None:
        header = header.where(F.col("eval_set") == eval_set)
        if "eval_set" in lines.columns:
            lines = lines.where(F.col("eval_set") == eval_set)
    header = apply_user_limit(
        header.where(F.col("order_id").isNotNull() & F.col("user_id").isNotNull()),
        user_limit).select(*_HEADER_COLUMNS)
    body = lines.where(F.col("order_id").isNotNull() & F.col("product_id").isNotNull())
    return body.join(header, "order_id").select(*LINE_COLUMNS)


def history_header(orders: DataFrame, user_limit: int | None = None) -> DataFrame:
    """Headers of prior and newest (``train``) orders with ``is_newest``; one row
    per order.  Null keys are dropped: they can neither group nor join."""
    header = orders.where(F.col("eval_set").isin("prior", "train")
                          & F.col("order_id").isNotNull() & F.col("user_id").isNotNull())
    return apply_user_limit(header, user_limit).select(
        *_HEADER_COLUMNS, (F.col("eval_set") == "train").alias("is_newest"))


def history_lines(lines: DataFrame) -> DataFrame:
    """Raw order lines; a line table stored by ``eval_set`` is pruned by it."""
    if "eval_set" in lines.columns:
        lines = lines.where(F.col("eval_set").isin("prior", "train"))
    return (lines.where(F.col("order_id").isNotNull() & F.col("product_id").isNotNull())
            .select("order_id", "product_id", "add_to_cart_order"))


def load_basket(orders: DataFrame, lines: DataFrame,
                user_limit: int | None = None) -> tuple[DataFrame, DataFrame]:
    """(prior, newest) joined line tables."""
    prior = join_order_header(lines, orders, "prior", user_limit)
    newest = join_order_header(lines, orders, "train", user_limit)
    return prior, newest


def read_products_csv(spark: SparkSession, path: str) -> DataFrame:
    """Product dimension from a CSV with a header row, every column kept: those of the
    schema with its types, others as text.  A quote inside a quoted field is doubled;
    quoted fields may hold commas and line feeds (files are read whole for that, which
    a dimension allows).  The header is the only thing read before the scan."""
    options = {**CSV, "multiLine": True}
    names = spark.read.options(**options).csv(path).columns
    known = {f.name: f for f in PRODUCTS_SCHEMA.fields}
    fields = [known.get(n, T.StructField(n, T.StringType(), True)) for n in names]
    return spark.read.options(**options).schema(T.StructType(fields)).csv(path)
