"""Hand-made frames (FIXTURES.md section 3)."""

from cartwise.schema import LINES_SCHEMA

# (order_id, user_id, order_number, dow, hour, gap, [products in cart order])
PRIOR_ORDERS = [
    (101, 1, 1, 1, 1, None, [10, 40]),
    (102, 1, 2, 2, 2, 5, [20, 40]),
    (103, 1, 3, 3, 3, 10, [40, 30, 10]),
    (104, 1, 4, 4, 4, 3, [40]),
    (105, 1, 5, 5, 5, 7, [40]),
    (106, 1, 6, 6, 6, 2, [40]),
    (107, 1, 7, 0, 7, 4, [10]),
    (201, 2, 1, 1, 8, None, [10]),
    (301, 3, 1, 0, 0, None, [10]),
    (302, 3, 2, 0, 0, 3, [10, 20]),
    (303, 3, 3, 0, 0, 3, [20]),
]
NEWEST_ORDERS = [
    (108, 1, 8, 1, 8, 6, [10, 50]),
    (202, 2, 2, 2, 9, 3, [60]),
    (401, 4, 1, 3, 3, None, [10]),
]


def _lines(orders):
    rows = []
    for oid, uid, onum, dow, hour, gap, cart in orders:
        for pos, pid in enumerate(cart, start=1):
            rows.append((oid, pid, pos, uid, onum, dow, hour, gap))
    return rows


def basket_frames(spark):
    prior = spark.createDataFrame(_lines(PRIOR_ORDERS), LINES_SCHEMA)
    newest = spark.createDataFrame(_lines(NEWEST_ORDERS), LINES_SCHEMA)
    return prior, newest


# Expected feature rows, worked out by hand.
EXPECTED = {
    (1, 10): dict(in_cart=1, percent_in_user_orders=3 / 7, percent_in_all_orders=6 / 11,
                  in_last_cart=1, in_last_five=2, total_user_orders=7,
                  mean_orders_between=13 / 3, mean_days_between=68 / 3,
                  orders_since_newest=1, days_since_newest=10, product_reorder_proba=0.5,
                  user_reorder_proba=7 / 11, mean_cart_size=2.0, mean_cart_percentile=7 / 9,
                  mean_hour_of_week=107 / 3, newest_cart_size=2, newest_hour_of_week=32,
                  cart_size_difference=0.0, hour_of_week_difference=107 / 3 - 32),
    (1, 20): dict(in_cart=0, percent_in_user_orders=1 / 7, percent_in_all_orders=3 / 11,
                  in_last_cart=0, in_last_five=0, total_user_orders=7,
                  mean_orders_between=6.0, mean_days_between=37.0,
                  orders_since_newest=6, days_since_newest=37, product_reorder_proba=1 / 3,
                  user_reorder_proba=7 / 11, mean_cart_size=2.0, mean_cart_percentile=1.0,
                  mean_hour_of_week=50.0, newest_cart_size=2, newest_hour_of_week=32,
                  cart_size_difference=0.0, hour_of_week_difference=18.0),
    (1, 30): dict(in_cart=0, percent_in_user_orders=1 / 7, percent_in_all_orders=1 / 11,
                  in_last_cart=0, in_last_five=1, total_user_orders=7,
                  mean_orders_between=5.0, mean_days_between=32.0,
                  orders_since_newest=5, days_since_newest=32, product_reorder_proba=0.0,
                  user_reorder_proba=7 / 11, mean_cart_size=3.0, mean_cart_percentile=2 / 3,
                  mean_hour_of_week=75.0, newest_cart_size=2, newest_hour_of_week=32,
                  cart_size_difference=1.0, hour_of_week_difference=43.0),
    (1, 40): dict(in_cart=0, percent_in_user_orders=6 / 7, percent_in_all_orders=6 / 11,
                  in_last_cart=0, in_last_five=4, total_user_orders=7,
                  mean_orders_between=2.0, mean_days_between=64 / 6,
                  orders_since_newest=2, days_since_newest=12, product_reorder_proba=5 / 6,
                  user_reorder_proba=7 / 11, mean_cart_size=10 / 6, mean_cart_percentile=5 / 6,
                  mean_hour_of_week=87.5, newest_cart_size=2, newest_hour_of_week=32,
                  cart_size_difference=1 / 3, hour_of_week_difference=55.5),
    (2, 10): dict(in_cart=0, percent_in_user_orders=1.0, percent_in_all_orders=6 / 11,
                  in_last_cart=1, in_last_five=1, total_user_orders=1,
                  mean_orders_between=1.0, mean_days_between=3.0,
                  orders_since_newest=1, days_since_newest=3, product_reorder_proba=0.5,
                  user_reorder_proba=0.0, mean_cart_size=1.0, mean_cart_percentile=1.0,
                  mean_hour_of_week=32.0, newest_cart_size=1, newest_hour_of_week=57,
                  cart_size_difference=0.0, hour_of_week_difference=25.0),
}

# Evaluation frame: (user, label, score); threshold 0.5.
EVAL_ROWS = [
    (1, 1, 0.9), (1, 1, 0.3), (1, 0, 0.6), (1, 0, 0.1), (1, 1, 0.2),  # tp1 fp1 fn2 -> 0.4
    (2, 1, 0.8), (2, 0, 0.2),                                          # perfect -> 1.0
    (3, 0, 0.1), (3, 0, 0.2),                                          # nothing -> 0.0
    (4, 1, 0.5),                                                       # == threshold -> 1.0
]
EXPECTED_USER_F1 = {1: 0.4, 2: 1.0, 3: 0.0, 4: 1.0}
