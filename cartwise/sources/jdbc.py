"""Order history from a relational database, spread over tasks.

The header and line reads are subqueries: the columns needed, the kinds of orders and
the user limit are applied by the database, to the lines through their orders.  A read
is cut into ranges of ``order_id``: their bounds come from the smallest and largest id
that the subquery itself returns, their number from its rows; where ids are dealt
unevenly, ``balanced`` asks the database for the ids at equal shares of the rows.
Only these bounds reach the driver.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from cartwise.sources.readers import _HEADER_COLUMNS

ROWS_PER_TASK = 1_000_000
MOST_TASKS = 200         # connections that a database may be asked for at once
FETCH_ROWS = 10_000      # rows a connection returns at a time
_NAME = re.compile(r"[A-Za-z_][A-Za-z0-9_$]*(\.[A-Za-z_][A-Za-z0-9_$]*){0,2}")


def _table(name: str) -> str:
    if not _NAME.fullmatch(name):
        raise ValueError(f"not a table name: {name!r}")
    return name


def _limit(user_limit: int | None, alias: str = "") -> str:
    return "" if user_limit is None or user_limit <= 0 else f" AND {alias}user_id < {int(user_limit)}"


def header_query(orders: str, user_limit: int | None = None) -> str:
    """Headers of prior and newest orders."""
    columns = ", ".join([*_HEADER_COLUMNS, "eval_set"])
    return (f"SELECT {columns} FROM {_table(orders)} WHERE eval_set IN ('prior', 'train')"
            f" AND order_id IS NOT NULL AND user_id IS NOT NULL{_limit(user_limit)}")


def lines_query(lines: list[str], orders: str, user_limit: int | None = None) -> str:
    """Lines of one or several tables (prior and newest lines may be kept apart)."""
    some = _limit(user_limit, "o.")
    of_users = (f" AND EXISTS (SELECT 1 FROM {_table(orders)} o WHERE o.order_id = l.order_id{some})"
                if some else "")
    return " UNION ALL ".join(
        f"SELECT l.order_id, l.product_id, l.add_to_cart_order FROM {_table(t)} l"
        f" WHERE l.order_id IS NOT NULL AND l.product_id IS NOT NULL{of_users}" for t in lines)


def bounds_query(query: str, column: str = "order_id") -> str:
    return f"SELECT min({column}) AS low, max({column}) AS high, count(*) AS n FROM ({query}) t"


def shares_query(query: str, parts: int, column: str = "order_id") -> str:
    """The largest id of each of ``parts`` equal shares of the rows, in order."""
    return (f"SELECT max({column}) AS cut FROM (SELECT {column}, ntile({int(parts)}) OVER"
            f" (ORDER BY {column}) AS part FROM ({query}) t) s GROUP BY part ORDER BY cut")


@dataclass
class JdbcSource:
    url: str
    driver: str | None = None
    properties: dict = field(default_factory=dict)
    rows_per_task: int = ROWS_PER_TASK
    most_tasks: int = MOST_TASKS
    fetch_rows: int = FETCH_ROWS
    balanced: bool = False

    def options(self, query: str) -> dict:
        own = {"driver": self.driver} if self.driver else {}
        return {**self.properties, **own, "url": self.url, "dbtable": f"({query}) t",
                "fetchsize": str(self.fetch_rows)}

    def _rows(self, spark: SparkSession, query: str) -> list:
        return spark.read.format("jdbc").options(**self.options(query)).load().collect()

    def tasks(self, n: int) -> int:
        return max(1, min(self.most_tasks, -(-n // self.rows_per_task)))

    def range_options(self, query: str, low, high, n: int, column: str = "order_id") -> dict:
        """Reader options that cut the query into ranges between its own bounds."""
        tasks = self.tasks(n)
        if not n or tasks == 1 or low == high:
            return self.options(query)
        return {**self.options(query), "partitionColumn": column, "lowerBound": str(low),
                "upperBound": str(high + 1), "numPartitions": str(tasks)}

    @staticmethod
    def share_predicates(cuts: list, column: str = "order_id") -> list[str]:
        """Conditions that meet every row once, cut after the given ids."""
        inner = sorted(set(cuts))[:-1]  # the last share has no end
        if not inner:
            return ["1 = 1"]
        middle = [f"{column} > {a} AND {column} <= {b}" for a, b in zip(inner, inner[1:])]
        return [f"{column} <= {inner[0]}", *middle, f"{column} > {inner[-1]}"]

    def read(self, spark: SparkSession, query: str, column: str = "order_id") -> DataFrame:
        bounds = self._rows(spark, bounds_query(query, column))[0]
        low, high, n = bounds[0], bounds[1], int(bounds[2])
        if self.balanced and self.tasks(n) > 1:
            cuts = [int(r[0]) for r in self._rows(spark, shares_query(query, self.tasks(n), column))]
            options = self.options(query)
            properties = {k: v for k, v in options.items() if k not in ("url", "dbtable")}
            return spark.read.jdbc(self.url, options["dbtable"],
                                   predicates=self.share_predicates(cuts, column), properties=properties)
        options = self.range_options(query, low and int(low), high and int(high), n, column)
        return spark.read.format("jdbc").options(**options).load()

    def order_history(self, spark: SparkSession, orders: str, lines: list[str],
                      user_limit: int | None = None) -> tuple[DataFrame, DataFrame]:
        """(orders header, order lines)."""
        return (self.read(spark, header_query(orders, user_limit)),
                self.read(spark, lines_query(lines, orders, user_limit)))
