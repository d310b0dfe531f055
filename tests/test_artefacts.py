"""One commit for a set of artefacts, the product CSV, and reads from a database."""

import os
import re

import duckdb
import pytest

from cartwise import __main__ as cli
from cartwise.models.train import fit_gbt, fit_logistic_regression
from cartwise.operators import recommend as rec
from cartwise.plans import build
from cartwise.schema import PRODUCTS_SCHEMA
from cartwise.sources import artefacts
from cartwise.sources.artefacts import ArtefactStore
from cartwise.sources.jdbc import (JdbcSource, bounds_query, header_query, lines_query,
                                   shares_query)
from cartwise.sources.readers import read_products_csv
from cartwise.sources.sinks import write_table

FEATS = ["a", "b"]


@pytest.fixture(scope="module")
def data(spark):
    rows = [(i // 4, i, (i * 7) % 3 % 2, float(i % 10) / 10, float(i % 7) / 7) for i in range(240)]
    return spark.createDataFrame(rows, "user_id long, product_id long, in_cart int, a double, b double")


# ---- manifests ---------------------------------------------------------------------
def save(spark, out, data, marker):
    with ArtefactStore(spark, out).begin() as run:
        write_table(spark.range(marker), run.part("test_set"))
        return run.publish()


def test_a_build_that_breaks_between_two_models_leaves_the_old_set(spark, data, tmp_path, monkeypatch):
    out = str(tmp_path / "out")
    monkeypatch.setattr(build, "FEATURES", FEATS)
    build.train_from_matrix(spark, data, out, gbt_iter=2)
    first = build.load_saved(spark, out)
    runs = os.listdir(os.path.join(out, "runs"))
    real = build.save_model

    def breaks(model, path):
        if path.endswith("model_gbt"):
            raise RuntimeError("lost")
        return real(model, path)

    monkeypatch.setattr(build, "save_model", breaks)
    with pytest.raises(RuntimeError):
        build.train_from_matrix(spark, data.where("user_id < 30"), out, gbt_iter=1)
    again = build.load_or_build(spark, out, lambda: pytest.fail("rebuilt"))
    assert sorted(map(tuple, again.test.collect())) == sorted(map(tuple, first.test.collect()))
    assert again.gbt.stages[-1].getNumTrees == 2
    assert os.listdir(os.path.join(out, "runs")) == runs  # what the broken build wrote is gone
    monkeypatch.setattr(build, "save_model", real)
    build.train_from_matrix(spark, data, out, gbt_iter=1)
    assert build.load_saved(spark, out).gbt.stages[-1].getNumTrees == 1


def test_unreadable_and_unfinished_manifests_and_missing_parts_fall_back(spark, data, tmp_path, monkeypatch):
    out = str(tmp_path / "out")
    monkeypatch.setattr(build, "FEATURES", FEATS)
    assert build.load_saved(spark, out) is None
    build.train_from_matrix(spark, data, out, gbt_iter=2)
    store = ArtefactStore(spark, out)
    for text in ('{"number": 2, "par', "{}", "[]", '{"parts": 3}'):
        number = max(store._numbers()) + 1
        (tmp_path / "out" / "manifests" / f"{number:08d}.json").write_text(text)
        assert store.current().number == 1
        assert build.load_saved(spark, out).gbt.stages[-1].getNumTrees == 2
    store.publish({"test_set": "runs/none/test_set", "model_lr": "runs/none/l", "model_gbt": "runs/none/g"})
    assert store.current().number == 6
    assert build.load_saved(spark, out).gbt.stages[-1].getNumTrees == 2  # one whole set, not a mixture


def test_evaluation_joins_the_set_it_was_made_from_and_old_runs_go(spark, data, tmp_path):
    store = ArtefactStore(spark, str(tmp_path))
    first = save(spark, str(tmp_path), data, 3)
    with store.begin() as run:
        write_table(spark.range(1), run.part("user_f1"))
        both = run.publish(store.current())
    assert set(both.parts) == {"test_set", "user_f1"} and first.number == 1 and both.number == 2
    assert spark.read.parquet(store.path(both, "test_set")).count() == 3
    assert store.path(first, "user_f1") is None
    last = [save(spark, str(tmp_path), data, n) for n in (4, 5)][-1]
    assert [m.number for m in store.manifests()] == [4, 3] and len(os.listdir(tmp_path / "runs")) == artefacts.KEEP
    assert spark.read.parquet(store.path(last, "test_set")).count() == 5


def test_two_publications_at_once_get_two_numbers(spark, tmp_path, monkeypatch):
    store = ArtefactStore(spark, str(tmp_path))
    store.publish({"x": "runs/a/x"})
    monkeypatch.setattr(store, "_numbers", lambda: [])  # as if the first were not seen yet
    assert store.publish({"x": "runs/b/x"}).number == 2


# ---- the product CSV -----------------------------------------------------------------
def test_product_names_with_quotes_commas_and_line_feeds(spark, tmp_path):
    path = tmp_path / "products.csv"
    path.write_text('product_id,product_name,aisle_id,department_id,brand\n'
                    '1,"Plates ""X"" big, 7 inch",5,6,Acme\n'
                    '2,"Two\nlines",7,8,\n'
                    '3,Back\\slash,9,1,"a\\"\n'
                    '4,,,,\n')
    df = read_products_csv(spark, str(path))
    assert [f.name for f in df.schema][:4] == [f.name for f in PRODUCTS_SCHEMA] and df.columns[4] == "brand"
    assert [f.dataType for f in df.schema][:4] == [f.dataType for f in PRODUCTS_SCHEMA]
    assert [tuple(r) for r in df.orderBy("product_id").collect()] == [
        (1, 'Plates "X" big, 7 inch', 5, 6, "Acme"), (2, "Two\nlines", 7, 8, None),
        (3, "Back\\slash", 9, 1, "a\\"), (4, None, None, None, None)]
    scores = spark.createDataFrame([(9, 1, 0.2), (9, 2, 0.7), (9, 5, 0.1)],
                                   "user_id long, product_id long, score double")
    listed = rec.recommend_for_user(scores, df, 9).collect()
    assert [(r.product_id, r.product_name, r.aisle_id, r.department_id) for r in listed] == [
        (2, "Two\nlines", 7, 8), (1, 'Plates "X" big, 7 inch', 5, 6), (5, None, None, None)]
    top = rec.recommend_topk(scores, 2, products=df)
    assert top.columns == ["user_id", "rank", "product_id", "product_name", "aisle_id", "department_id",
                           "brand", "score"]
    assert [(r["rank"], r.aisle_id) for r in top.orderBy("rank").collect()] == [(1, 7), (2, 5)]


def test_columns_in_another_order_keep_their_types(spark, tmp_path):
    path = tmp_path / "p.csv"
    path.write_text("aisle_id,product_id\n3,10\n")
    assert [tuple(r) for r in read_products_csv(spark, str(path)).collect()] == [(3, 10)]


def test_written_csv_is_read_by_other_programs(spark, tmp_path):
    import pandas as pd

    rows = [(1, 'a "b", c'), (2, "back\\slash"), (3, 'ends in "')]
    write_table(spark.createDataFrame(rows, "k long, v string").coalesce(1), str(tmp_path / "t"), fmt="csv")
    (name,) = [f for f in os.listdir(tmp_path / "t") if f.endswith(".csv")]
    assert [tuple(r) for r in pd.read_csv(tmp_path / "t" / name).itertuples(index=False)] == rows


# ---- reads from a database: the SQL and the plan of a read, not the connection ---------
@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    con.execute("create table orders as select i as order_id, i % 50 as user_id, 1 as order_number,"
                " 0 as order_dow, 0 as order_hour_of_day, null::int as days_since_prior_order,"
                " case i % 10 when 0 then 'train' when 1 then 'test' else 'prior' end as eval_set"
                " from range(1000, 3000) t(i)")
    con.execute("insert into orders values (null, 1, 1, 0, 0, null, 'prior'), (9, null, 1, 0, 0, null, 'prior')")
    con.execute("create table ordersprior as select order_id, p as product_id, 1 as add_to_cart_order"
                " from orders, range(3) t(p) where eval_set = 'prior'")
    con.execute("create table orderstrain as select order_id, 7 as product_id, 1 as add_to_cart_order"
                " from orders where eval_set = 'train' union all select 1000, null, 1")
    return con


def test_header_filter_user_limit_and_columns_are_pushed(db):
    rows = db.sql(header_query("orders", 5)).df()
    assert set(rows.eval_set) == {"prior", "train"} and rows.user_id.max() == 4 and rows.order_id.notna().all()
    assert len(rows) == db.sql("select count(*) from orders where user_id < 5 and eval_set <> 'test'"
                               " and order_id is not null").fetchall()[0][0]
    assert db.sql(header_query("orders", -1)).df().user_id.max() == 49


def test_lines_follow_the_users_of_their_orders(db):
    every = db.sql(lines_query(["ordersprior", "orderstrain"], "orders")).df()
    some = db.sql(lines_query(["ordersprior", "orderstrain"], "orders", 5)).df()
    assert list(every.columns) == ["order_id", "product_id", "add_to_cart_order"]
    users = dict(db.sql("select order_id, user_id from orders where order_id is not null").fetchall())
    want = every[[users.get(o) is not None and users[o] < 5 for o in every.order_id]]
    assert len(some) == len(want) and set(some.order_id) == set(want.order_id)
    assert "JOIN" not in lines_query(["l"], "o") and "orders" not in lines_query(["l"], "orders")
    for bad in ("orders; drop table x", "a b", "", "x--"):
        with pytest.raises(ValueError):
            lines_query([bad], "orders")
    assert "FROM shop.public.orders" in header_query("shop.public.orders")


def ranges(options):
    """The conditions Spark's reader makes of its bounds."""
    low, high, n = int(options["lowerBound"]), int(options["upperBound"]), int(options["numPartitions"])
    stride = (high - low) / n
    cuts = [low + int(stride * i) for i in range(1, n)]
    c = options["partitionColumn"]
    return [f"{c} < {cuts[0]} OR {c} IS NULL", *[f"{c} >= {a} AND {c} < {b}" for a, b in zip(cuts, cuts[1:])],
            f"{c} >= {cuts[-1]}"]


def test_ranges_come_from_the_tables_own_bounds(db):
    source = JdbcSource("jdbc:x", "d", rows_per_task=400, most_tasks=7)
    query = lines_query(["ordersprior", "orderstrain"], "orders")
    low, high, n = db.sql(bounds_query(query)).fetchall()[0]
    assert (low, high) == (9, 2999) and n == db.sql(f"select count(*) from ({query})").fetchall()[0][0]
    options = source.range_options(query, low, high, n)
    assert options == {"url": "jdbc:x", "driver": "d", "dbtable": f"({query}) t", "fetchsize": "10000",
                       "partitionColumn": "order_id", "lowerBound": "9", "upperBound": "3000",
                       "numPartitions": "7"}
    counts = [db.sql(f"select count(*) from ({query}) where {c}").fetchall()[0][0] for c in ranges(options)]
    assert sum(counts) == n
    few = source.range_options(query, 1, 1, 400)
    assert "partitionColumn" not in few and "partitionColumn" not in source.range_options(query, None, None, 0)
    assert JdbcSource("u").tasks(10 ** 12) == 200 and JdbcSource("u").tasks(3) == 1


def test_balanced_ranges_hold_equal_shares_of_uneven_ids(db):
    db.execute("create or replace table uneven as select case when i < 900 then i else i * 1000000 end"
               " as order_id, 1 as product_id, 1 as add_to_cart_order from range(1000) t(i)")
    query = lines_query(["uneven"], "orders")
    cuts = [r[0] for r in db.sql(shares_query(query, 8)).fetchall()]
    counts = [db.sql(f"select count(*) from ({query}) where {p}").fetchall()[0][0]
              for p in JdbcSource.share_predicates(cuts)]
    assert sum(counts) == 1000 and len(counts) == 8 and max(counts) == 125
    same = JdbcSource.share_predicates([4, 4, 4])
    assert same == ["1 = 1"]
    assert JdbcSource.share_predicates([1, 5, 5, 9]) == [
        "order_id <= 1", "order_id > 1 AND order_id <= 5", "order_id > 5"]


class Reads:
    """Stands in for a session's reader; answers the bounds and shares from DuckDB."""

    def __init__(self, db):
        self.db, self.loads, self.jdbcs = db, [], []
        self.read = self

    def format(self, name):
        assert name == "jdbc"
        return self

    def options(self, **options):
        self.asked = options
        return self

    def load(self):
        self.loads.append(self.asked)
        return self

    def collect(self):
        query = re.fullmatch(r"\((.*)\) t", self.loads.pop()["dbtable"])[1]
        return self.db.sql(query).fetchall()

    def jdbc(self, url, table, predicates, properties):
        self.jdbcs.append((url, table, predicates, properties))
        return self


def test_a_read_asks_for_bounds_first(db):
    spark = Reads(db)
    JdbcSource("jdbc:x", rows_per_task=500).order_history(spark, "orders", ["ordersprior", "orderstrain"], 20)
    header, lines = spark.loads
    assert header["dbtable"] == f"({header_query('orders', 20)}) t" and int(header["numPartitions"]) == 2
    assert int(lines["lowerBound"]) >= 1000 and "user_id < 20" in lines["dbtable"]
    spark = Reads(db)
    JdbcSource("jdbc:x", "d", rows_per_task=500, balanced=True).read(spark, lines_query(["ordersprior"], "orders"))
    (url, _, predicates, properties) = spark.jdbcs[0]
    assert url == "jdbc:x" and properties == {"driver": "d", "fetchsize": "10000"} and len(predicates) == 10
    spark = Reads(db)
    db.execute("create or replace table nothing as select * from ordersprior limit 0")
    JdbcSource("jdbc:x").read(spark, lines_query(["nothing"], "orders"))
    assert "partitionColumn" not in spark.loads[0]


def test_command_line_reads_both_line_tables(monkeypatch):
    seen = []
    monkeypatch.setattr(JdbcSource, "order_history", lambda self, *a: seen.append((self, *a)) or ("o", "l"))
    args = type("A", (), dict(testdata=None, jdbc_url="jdbc:x", jdbc_driver="d", orders=None,
                              lines="ordersprior,orderstrain", user_limit=9, jdbc_rows=5, jdbc_connections=3,
                              jdbc_balanced=True))
    assert cli._history("spark", args) == ("o", "l")
    source, *rest = seen[0]
    assert rest == ["spark", "orders", ["ordersprior", "orderstrain"], 9]
    assert (source.url, source.driver, source.rows_per_task, source.most_tasks, source.balanced) == (
        "jdbc:x", "d", 5, 3, True)
    args.jdbc_url = None
    args.lines = None
    with pytest.raises(SystemExit):
        cli._history("spark", args)


def test_models_still_load_from_a_plain_folder(spark, data, tmp_path):
    out = str(tmp_path)
    write_table(data, out + "/test_set")
    fit_logistic_regression(data, FEATS).write().save(out + "/model_lr")
    fit_gbt(data, FEATS, max_iter=1).write().save(out + "/model_gbt")
    assert build.load_saved(spark, out).test.count() == 240
