"""Column names and explicit schemas.

Schemas are declared, never inferred: line tables, order headers and the
feature matrix all have fixed column sets.
"""

from pyspark.sql import types as T

ID_COL = "user_id"
ITEM_COL = "product_id"
LABEL_COL = "in_cart"

# The eighteen model features, in the order the models use.
FEATURES = [
    "percent_in_user_orders",
    "percent_in_all_orders",
    "in_last_cart",
    "in_last_five",
    "total_user_orders",
    "mean_orders_between",
    "mean_days_between",
    "orders_since_newest",
    "days_since_newest",
    "product_reorder_proba",
    "user_reorder_proba",
    "mean_cart_size",
    "mean_cart_percentile",
    "mean_hour_of_week",
    "newest_cart_size",
    "newest_hour_of_week",
    "cart_size_difference",
    "hour_of_week_difference",
]

# Columns of a joined line table (order line + its order header).
LINE_COLUMNS = [
    "order_id",
    "product_id",
    "add_to_cart_order",
    "user_id",
    "order_number",
    "order_dow",
    "order_hour_of_day",
    "days_since_prior_order",
]

ORDERS_SCHEMA = T.StructType([
    T.StructField("order_id", T.LongType(), False),
    T.StructField("user_id", T.LongType(), False),
    T.StructField("order_number", T.IntegerType(), False),
    T.StructField("order_dow", T.IntegerType(), False),
    T.StructField("order_hour_of_day", T.IntegerType(), False),
    T.StructField("days_since_prior_order", T.IntegerType(), True),
    T.StructField("eval_set", T.StringType(), True),
])

ORDER_LINES_SCHEMA = T.StructType([
    T.StructField("order_id", T.LongType(), False),
    T.StructField("product_id", T.LongType(), False),
    T.StructField("add_to_cart_order", T.IntegerType(), False),
])

LINES_SCHEMA = T.StructType([
    T.StructField("order_id", T.LongType(), False),
    T.StructField("product_id", T.LongType(), False),
    T.StructField("add_to_cart_order", T.IntegerType(), False),
    T.StructField("user_id", T.LongType(), False),
    T.StructField("order_number", T.IntegerType(), False),
    T.StructField("order_dow", T.IntegerType(), False),
    T.StructField("order_hour_of_day", T.IntegerType(), False),
    T.StructField("days_since_prior_order", T.IntegerType(), True),
])

PRODUCTS_SCHEMA = T.StructType([
    T.StructField("product_id", T.LongType(), False),
    T.StructField("product_name", T.StringType(), True),
    T.StructField("aisle_id", T.IntegerType(), True),
    T.StructField("department_id", T.IntegerType(), True),
])

# Feature types in the assembled matrix.
FEATURE_TYPES = {
    "percent_in_user_orders": T.DoubleType(),
    "percent_in_all_orders": T.DoubleType(),
    "in_last_cart": T.IntegerType(),
    "in_last_five": T.LongType(),
    "total_user_orders": T.LongType(),
    "mean_orders_between": T.DoubleType(),
    "mean_days_between": T.DoubleType(),
    "orders_since_newest": T.IntegerType(),
    "days_since_newest": T.LongType(),
    "product_reorder_proba": T.DoubleType(),
    "user_reorder_proba": T.DoubleType(),
    "mean_cart_size": T.DoubleType(),
    "mean_cart_percentile": T.DoubleType(),
    "mean_hour_of_week": T.DoubleType(),
    "newest_cart_size": T.IntegerType(),
    "newest_hour_of_week": T.IntegerType(),
    "cart_size_difference": T.DoubleType(),
    "hour_of_week_difference": T.DoubleType(),
}
