"""Plan checks: no cartesian products, no Python evaluation in the feature
plan, pruned scans, and a bounded number of exchanges."""

import re

import pytest

from cartwise.operators import features as fx
from cartwise.operators.basket import Basket
from cartwise.sources.adapter import tpch_order_history
from cartwise.sources.readers import load_basket
from tests.conftest import SF_SMALL


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def lazy_matrix(spark):
    orders, lines = tpch_order_history(spark, SF_SMALL)
    prior, newest = load_basket(orders, lines)
    return fx.feature_matrix(Basket(prior, newest, materialize=False))


def test_no_cartesian_or_python(lazy_matrix):
    p = _plan(lazy_matrix)
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython",
                "ArrowEvalPython", "FlatMapGroupsInPandas"):
        assert bad not in p, bad


def test_scans_are_pruned(lazy_matrix):
    p = _plan(lazy_matrix)
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", p)
    assert schemas
    for s in schemas:
        cols = {c.split(":")[0] for c in s.split(",")}
        # never the whole lineitem / orders row
        assert "l_extendedprice" not in cols and "o_totalprice" not in cols, s


def test_staged_pairs_plan_has_few_exchanges(spark):
    from cartwise.sources import history

    prior, newest = history.basket_tables(spark, SF_SMALL)
    b = Basket(prior, newest)
    m = fx.feature_matrix(b)
    n = len(re.findall(r"Exchange (hash|single|range)", _plan(m), re.I))
    # pairs with users and with products, both written before
    assert n <= 4, n


def test_no_window_sorts_a_whole_user_history(spark):
    """Order-level windows are partitioned by (user, block); the only window
    partitioned by user alone runs over one row per block."""
    from cartwise.sources import history

    prior, newest = history.basket_tables(spark, SF_SMALL)
    b = Basket(prior, newest, materialize=False)
    p = _plan(b.timeline)
    specs = re.findall(r"windowspecdefinition\(([^)]*)\)", p)
    assert specs
    for spec in specs:
        parts = [x.strip() for x in spec.split(",")]
        if parts[0].startswith("user_id") and "order_number" in spec:
            assert parts[1].startswith("_blk"), spec
