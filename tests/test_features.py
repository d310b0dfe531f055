import math

import pytest

from cartwise.operators import features as fx
from cartwise.operators.basket import Basket
from cartwise.schema import FEATURES
from tests.fixtures import EXPECTED, basket_frames


@pytest.fixture(scope="module", params=[True, False], ids=["staged", "lazy"])
def basket(spark, request):
    prior, newest = basket_frames(spark)
    return Basket(prior, newest, block_size=3, materialize=request.param)


def _close(a, b):
    if isinstance(b, float):
        return a is not None and math.isclose(a, b, rel_tol=1e-9, abs_tol=1e-9)
    return a == b


def test_feature_matrix_matches_hand_worked_values(basket):
    rows = {(r.user_id, r.product_id): r.asDict() for r in fx.feature_matrix(basket).collect()}
    assert set(rows) == set(EXPECTED)
    for key, exp in EXPECTED.items():
        for col, val in exp.items():
            assert _close(rows[key][col], val), (key, col, rows[key][col], val)


def test_matrix_columns_and_no_nulls(basket):
    m = fx.feature_matrix(basket)
    assert m.columns == ["user_id", "product_id", "in_cart", *FEATURES]
    for r in m.collect():
        assert all(v is not None for v in r), r


def test_candidates_exclude_users_without_newest_or_prior(basket):
    users = {r.user_id for r in fx.candidates(basket).collect()}
    assert users == {1, 2}  # 3 has no newest order, 4 has no prior order


def test_user_without_newest_still_counts_in_product_statistics(spark):
    prior, newest = basket_frames(spark)
    full = {(r.user_id, r.product_id): r for r in
            fx.rate_overall(Basket(prior, newest)).collect()}
    without3 = prior.where("user_id <> 3")
    cut = {(r.user_id, r.product_id): r for r in
           fx.rate_overall(Basket(without3, newest)).collect()}
    assert set(full) == set(cut)
    assert full[(1, 10)].percent_in_all_orders == pytest.approx(6 / 11)
    assert cut[(1, 10)].percent_in_all_orders == pytest.approx(4 / 8)
    # per-user features of the remaining users do not change
    a = {k: v for k, v in (((r.user_id, r.product_id), r.percent_in_user_orders)
                           for r in fx.rate_by_user(Basket(without3, newest)).collect())}
    assert a[(1, 10)] == pytest.approx(3 / 7)


def test_order_timeline_sums_include_own_gap(basket):
    t = {r.order_id: r for r in fx.order_timeline(basket).collect()}
    assert [t[o].days_since_first_order for o in range(101, 108)] == [0, 5, 15, 18, 25, 27, 31]
    assert [t[o].days_since_newest for o in range(101, 108)] == [37, 37, 32, 22, 19, 12, 10]
    assert t[201].days_since_first_order == 0 and t[201].days_since_newest == 3
    assert t[301].days_since_newest is None  # user 3 has no newest order


def test_in_last_cart_implies_in_last_five(basket):
    for r in fx.feature_matrix(basket).collect():
        if r.in_last_cart == 1:
            assert r.in_last_five >= 1


def test_top_products(basket):
    got = [(r.product_id, r.count_in_all_orders) for r in fx.top_products(basket, 2).collect()]
    assert got == [(10, 6), (40, 6)]


def test_drop_newest_cart(basket):
    m = fx.feature_matrix(basket, drop_newest_cart=True)
    assert "newest_cart_size" not in m.columns and "cart_size_difference" not in m.columns


def test_release_deletes_staged_tables(spark):
    import os

    prior, newest = basket_frames(spark)
    b = Basket(prior, newest)
    n = fx.feature_matrix(b).count()
    staged = [p.replace("file:", "") for p in b._staged]
    assert n == 5 and staged and all(os.path.exists(p) for p in staged)
    b.release()
    assert not any(os.path.exists(p) for p in staged)
