import os

from pyspark.sql import functions as F

from cartwise.operators import features as fx
from cartwise.operators.basket import Basket
from cartwise.schema import LINE_COLUMNS, PRODUCTS_SCHEMA
from cartwise.sources.readers import apply_user_limit, join_order_header, read_products_csv
from cartwise.sources.sinks import read_table, try_read_table, write_table
from tests.fixtures import basket_frames


def test_user_limit_is_an_id_bound(spark):
    prior, newest = basket_frames(spark)
    assert {r.user_id for r in apply_user_limit(prior, 2).collect()} == {1}
    assert apply_user_limit(prior, 0).count() == prior.count()
    assert apply_user_limit(prior, -1).count() == prior.count()
    b = Basket(apply_user_limit(prior, 3), apply_user_limit(newest, 3))
    assert {r.user_id for r in fx.candidates(b).collect()} == {1, 2}


def test_join_order_header_selects_eval_set_and_drops_null_keys(spark):
    orders = spark.createDataFrame(
        [(1, 10, 1, 0, 0, None, "prior"), (2, 10, 2, 0, 0, 3, "train"),
         (3, None, 1, 0, 0, None, "prior")],
        "order_id long, user_id long, order_number int, order_dow int, "
        "order_hour_of_day int, days_since_prior_order int, eval_set string")
    lines = spark.createDataFrame([(1, 5, 1), (2, 5, 1), (2, 6, 2), (3, 7, 1), (None, 8, 1)],
                                  "order_id long, product_id long, add_to_cart_order int")
    prior = join_order_header(lines, orders, "prior")
    newest = join_order_header(lines, orders, "train")
    assert prior.columns == LINE_COLUMNS
    assert [(r.order_id, r.product_id) for r in prior.collect()] == [(1, 5)]
    assert sorted(r.product_id for r in newest.collect()) == [5, 6]


def test_csv_and_parquet_round_trip(spark, tmp_path):
    prior, _ = basket_frames(spark)
    for fmt in ("parquet", "csv"):
        path = str(tmp_path / f"lines_{fmt}")
        write_table(prior, path, fmt=fmt)
        back = read_table(spark, path, fmt=fmt, schema=prior.schema)
        assert sorted(map(tuple, back.collect()), key=repr) == \
            sorted(map(tuple, prior.collect()), key=repr)
    assert try_read_table(spark, str(tmp_path / "nothing")) is None


def test_products_csv_reader(spark, tmp_path):
    path = tmp_path / "products.csv"
    path.write_text("product_id,product_name\n10,Bananas\n20,Milk\n")
    df = read_products_csv(spark, str(path))
    assert df.schema == PRODUCTS_SCHEMA or [f.name for f in df.schema] == ["product_id",
                                                                         "product_name"]
    assert {r.product_id: r.product_name for r in df.collect()} == {10: "Bananas", 20: "Milk"}


def test_partitioned_write(spark, tmp_path):
    prior, _ = basket_frames(spark)
    path = str(tmp_path / "by_user")
    write_table(prior, path, partition_by=["user_id"])
    assert {"user_id=1", "user_id=2", "user_id=3"} <= set(os.listdir(path))
    back = spark.read.parquet(path).where(F.col("user_id") == 2)
    assert back.count() == 1
