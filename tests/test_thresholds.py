"""Mean per-user F1 at every threshold, against a recount at each of them."""

import math
import random

import pytest
from pyspark.sql import functions as F

from cartwise.operators import evaluate as ev

SCHEMA = "user_id long, in_cart int, score double"


def rows(seed, n=600):
    rng = random.Random(seed)
    out = []
    for _ in range(n):
        score = rng.choice([rng.random(), rng.randrange(101) / 100, 0.0, 1.0, None, math.nan, -0.5, 1.5])
        out.append((rng.choice([None, *range(40)]), rng.randrange(2), score))
    return out + [(900, 0, 0.3), (900, 0, None), (901, 1, None), (902, 1, 1.0)]


def recount(data, steps=100):
    """{threshold: (users, mean F1)}"""
    out = {}
    for k in range(steps + 1):
        t, users = k / steps, {}
        for u, y, p in data:
            hit = p is not None and (math.isnan(p) or p >= t)
            c = users.setdefault(u, [0, 0, 0])
            c[0] += hit and y == 1
            c[1] += hit and y == 0
            c[2] += not hit and y == 1
        f1 = [0.0 if not (2 * a + b + c) else 2 * a / (2 * a + b + c) for a, b, c in users.values()]
        out[t] = (len(users), sum(f1) / len(f1))
    return out


@pytest.mark.parametrize("seed,steps", [(1, 100), (2, 100), (3, 7), (4, 1)])
def test_sweep_equals_a_recount_at_every_threshold(spark, seed, steps):
    data = rows(seed)
    df = spark.createDataFrame(data, SCHEMA).repartition(5)
    got = {r.threshold: (r.n_users, r.mean_f1) for r in ev.user_threshold_sweep(df, steps).collect()}
    want = recount(data, steps)
    assert got.keys() == want.keys()
    for t, (users, f1) in want.items():
        assert got[t][0] == users and got[t][1] == pytest.approx(f1, abs=1e-12)
        per_user = ev.mean_user_f1(ev.per_user_f1(df, t)).first() if t in (0.0, 1.0) else None
        assert per_user is None or per_user.mean_f1 == pytest.approx(f1)
    best = ev.best_user_threshold(ev.user_threshold_sweep(df, steps)).first()
    top = max(round(v[1], 9) for v in want.values())
    assert best.threshold == min(t for t, v in want.items() if round(v[1], 9) == top)


def test_no_rows_and_users_below_every_threshold(spark):
    none = ev.user_threshold_sweep(spark.createDataFrame([], SCHEMA), 10).collect()
    assert len(none) == 11 and all(r.n_users == 0 and r.mean_f1 is None for r in none)
    low = ev.user_threshold_sweep(spark.createDataFrame([(1, 1, None), (2, 0, -1.0)], SCHEMA), 10).collect()
    assert all((r.n_users, r.mean_f1) == (2, 0.0) for r in low)


def test_rows_are_combined_by_user_and_bucket_and_meet_no_threshold(spark):
    df = spark.createDataFrame(rows(5), SCHEMA)
    plan = ev.user_threshold_sweep(df)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
    lines = [x for x in plan.splitlines() if "Exchange hashpartitioning(user_id" in x]
    assert len(lines) == 2 and any("user_id" in x and "_grouping" in x for x in lines)  # cells, then at most 102 rows a user


def test_hot_user_is_combined_before_the_shuffle(spark):
    df = spark.range(20_000).select(F.lit(1).cast("long").alias("user_id"), (F.col("id") % 2).cast("int").alias(
        "in_cart"), ((F.col("id") % 101) / 100.0).alias("score"))
    got = ev.user_threshold_sweep(df)
    assert got.agg(F.max("n_users")).first()[0] == 1
    assert got.where("threshold = 0").first().mean_f1 == pytest.approx(2 / 3)
