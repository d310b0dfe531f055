"""Command line: build models from order history and evaluate them.

    python -m cartwise build --testdata /root/testdata/sf0.01 --out /shared/run1
    python -m cartwise build --orders o.parquet --lines l.parquet --out /shared/run1
    python -m cartwise evaluate --out /shared/run1 [--testdata DIR --rebuild]
    python -m cartwise build --jdbc-url jdbc:... --orders orders --lines lines --out /shared/run1

``--master`` is passed on as it is; without it, the session that spark-submit
set up is used.

``--user-limit N`` keeps users with user_id < N (0 or less: all users).
"""

from __future__ import annotations

import argparse
import json
import os
import re

from cartwise.plans.build import build_models, load_or_build
from cartwise.plans.evaluate import evaluate_models
from cartwise.schema import FEATURES, ORDER_LINES_SCHEMA, ORDERS_SCHEMA
from cartwise.session import local_session, session_on
from cartwise.sources.jdbc import MOST_TASKS, ROWS_PER_TASK, JdbcSource


def _history(spark, args):
    if args.testdata:
        from cartwise.sources import history
        return history.order_history(spark, args.testdata)
    if args.jdbc_url:
        source = JdbcSource(args.jdbc_url, args.jdbc_driver, rows_per_task=args.jdbc_rows,
                            most_tasks=args.jdbc_connections, balanced=args.jdbc_balanced)
        lines = (args.lines or "order_lines").split(",")
        return source.order_history(spark, args.orders or "orders", lines, args.user_limit)
    if not (args.orders and args.lines):
        raise SystemExit("no input: give --testdata, --orders and --lines, or --jdbc-url")
    return (spark.read.schema(ORDERS_SCHEMA).parquet(args.orders),
            spark.read.schema(ORDER_LINES_SCHEMA).parquet(args.lines))


def _session(master: str | None):
    if not master:
        from pyspark.sql import SparkSession
        return SparkSession.builder.appName("cartwise").getOrCreate()
    found = re.fullmatch(r"local(?:\[(\d+|\*)\])?", master)
    return local_session(found[1] or "1") if found else session_on(master)


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(prog="cartwise")
    ap.add_argument("command", choices=["build", "evaluate"])
    ap.add_argument("--testdata", help="folder of TPC-H-style test tables")
    ap.add_argument("--orders", help="orders header (parquet)")
    ap.add_argument("--lines", help="order lines (parquet; in a database, tables joined by commas)")
    ap.add_argument("--out", required=True, help="folder for the test set and models")
    ap.add_argument("--user-limit", type=int, default=-1)
    ap.add_argument("--gbt-iter", type=int, help="boosting rounds (default: chosen on held-out users)")
    ap.add_argument("--drop-newest-cart", action="store_true",
                    help="leave out the two features that describe the basket to be predicted")
    ap.add_argument("--jdbc-url", help="read the tables --orders and --lines from a database")
    ap.add_argument("--jdbc-driver")
    ap.add_argument("--jdbc-rows", type=int, default=ROWS_PER_TASK, help="rows a task reads")
    ap.add_argument("--jdbc-connections", type=int, default=MOST_TASKS, help="most tasks of a read")
    ap.add_argument("--jdbc-balanced", action="store_true",
                    help="cut the ids at equal shares of the rows (a sort in the database)")
    ap.add_argument("--rebuild", action="store_true")
    ap.add_argument("--master", default=os.environ.get("CARTWISE_MASTER"))
    args = ap.parse_args(argv)

    spark = _session(args.master)

    def build():
        orders, lines = _history(spark, args)
        return build_models(spark, orders, lines, out_dir=args.out,
                            user_limit=args.user_limit, gbt_iter=args.gbt_iter,
                            drop_newest_cart=args.drop_newest_cart)

    if args.command == "build":
        build()
        print(json.dumps({"built": args.out}))
    else:
        r = load_or_build(spark, args.out, build, force_rebuild=args.rebuild)
        features = [f for f in FEATURES if f in r.test.columns]
        print(json.dumps(evaluate_models(spark, r.test, r.lr, r.gbt, features, args.out),
                         default=str))


if __name__ == "__main__":
    main()
