"""Every query with SQL gives the rows of its SQL."""

import pytest

import __spark_entry__ as entry
from conftest import SF_SMALL


@pytest.mark.parametrize("name", ["op2_warc", "op6_substrings", "op7_mixing", "op8_jaccard",
                                  "op11_chat", "op13_negatives"])
def test_query_matches_sql(spark, duck, name):
    got = entry.queries()[name](spark, SF_SMALL).toPandas()
    want = duck(entry.oracle_sql()[name])
    key = list(got.columns)[:3] if name == "op13_negatives" else got.columns[0]
    got = got.sort_values(key).reset_index(drop=True)
    want = want[list(got.columns)].sort_values(key).reset_index(drop=True)
    assert len(got) == len(want)
    assert ((got == want) | (got.isna() & want.isna())).all().all()


def test_all_operators_and_the_pipeline_are_registered():
    names = list(entry.queries())
    for n in range(1, 14):
        assert any(x.startswith(f"op{n}_") for x in names)
    assert "pipeline" in names
