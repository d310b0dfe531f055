"""Registered queries vs their DuckDB oracle on the smallest fixture."""

import os

import duckdb
import pytest

import __spark_entry__ as E
from tests.conftest import SF_SMALL

def _own(names) -> list[str]:
    """Without the queries of the llm subpackage, which has its own tests."""
    return [n for n in names if n != "pipeline" and not n.startswith("op")]


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in ("orders", "lineitem", "part"):
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet("
                  f"'{os.path.join(SF_SMALL, t + '.parquet')}')")
    return c


def _canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    norm = [tuple(round(r[i], 6) if isinstance(r[i], float) else r[i] for i in order)
            for r in rows]
    return sorted(norm, key=repr)


@pytest.mark.parametrize("name", _own(E.oracle_sql()))
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF_SMALL)
    res = con.execute(E.oracle_sql()[name])
    dcols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(dcols)
    assert _canon(df.columns, [tuple(r) for r in df.collect()]) == _canon(dcols, res.fetchall())


def test_every_query_has_an_oracle_or_is_a_model_query():
    rows_only = set(_own(E.queries())) - set(E.oracle_sql())
    assert rows_only == {"logreg_scores", "gbt_scores", "feature_importance", "cv_out_of_fold"}


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns[:3] == ["user_id", "product_id", "in_cart"]
