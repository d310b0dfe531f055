"""Sources and sinks: parquet/CSV/JDBC readers, the fixture adapter that
turns the TPC-H-style test tables into order history, and writers."""

from cartwise.sources.readers import (  # noqa: F401
    apply_user_limit,
    join_order_header,
    load_basket,
    read_products_csv,
)
from cartwise.sources.jdbc import JdbcSource  # noqa: F401
from cartwise.sources.adapter import tpch_order_history, tpch_products  # noqa: F401
