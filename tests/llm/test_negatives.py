import math

import numpy as np
from pyspark.sql import functions as F

from cartwise.llm import negatives as neg

SCHEMA = "vec_id long, label long, embedding array<double>"


def quantised(v, scale=256):
    if v is None or any(x is None or not math.isfinite(x) or not math.isfinite(x * scale) for x in v):
        return None
    return tuple(math.floor(x * scale) if abs(x * scale) < 2.0 ** 53 else int(x * scale) for x in v)


def brute(rows, is_anchor, positives=5, negatives=5, low=80):
    """Sorted result rows, by scoring every row for every anchor."""
    usable = {(i, lab, quantised(v)) for i, lab, v in rows if i is not None and lab is not None}
    usable = [r for r in usable if r[2] is not None]
    out = []
    for a, label, q in usable:
        if not is_anchor(a):
            continue
        near, far = [], []
        for i, other, v in usable:
            if i != a and len(v) == len(q):
                s = max(-(1 << 63), min((1 << 63) - 1, sum(x * y for x, y in zip(q, v))))
                (near if other == label else far).append((-s, i))
        for ps, p in sorted(near)[:positives]:
            fit = sorted(x for x in far if low * -ps <= 100 * -x[0] <= 100 * -ps)[:negatives]
            out += [(a, p, k + 1, i, -ps, -s) for k, (s, i) in enumerate(fit)]
    return sorted(out)


def run(spark, rows, condition="vec_id % 10 = 0", **kw):
    df = rows if not isinstance(rows, list) else spark.createDataFrame(rows, SCHEMA)
    out = neg.hard_negatives(df, F.expr(condition), **kw)
    assert out.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score",
                           "negative_score"]
    return sorted(tuple(r) for r in out.collect())


def clustered(n=700, dim=16, seed=3, spread=0.25):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(12, dim))
    length = rng.lognormal(0, 0.6, n)
    return [(i, int(rng.integers(0, 4)),
             (length[i] * (centres[i % 12] + spread * rng.normal(size=dim))).tolist()) for i in range(n)]


def test_many_buckets_and_rounds_against_brute_force(spark):
    rows = clustered()
    want = brute(rows, lambda i: i % 10 == 0)
    assert len(want) > 500
    for bucket_rows in (4096, 100, 12):
        assert run(spark, rows, bucket_rows=bucket_rows) == want


def test_coordinate_ranges_prune_and_lose_nothing():
    rng = np.random.default_rng(4)
    rows = clustered(600, 8, 9, 0.05)
    v = np.array([r[2] for r in rows])
    v = np.floor(4096 * v / np.linalg.norm(v, axis=1)[:, None])
    kind, packed = neg._packed(v)
    lists = np.argsort(neg._unit(v)[0], axis=0, kind="stable").astype(np.int32)
    bucket = neg.Bucket({"ids": np.arange(600).tobytes(), "labels": np.zeros(600, np.int64).tobytes(),
                         "dim": 8, "vectors": packed, "kind": kind, "lists": lists.T.tobytes()})
    q = rng.permutation(v)[:60]
    scores = q @ v.T
    for share in (0.5, 0.9, 0.99, 1.0):
        floors = scores.max(axis=1) * share
        every, some = bucket.candidates(q, floors)
        looked = len(every) * 600 + sum(map(len, some.values()))
        for i in range(60):
            need = set(np.flatnonzero(scores[i] >= floors[i]).tolist())
            assert i in every or need <= set(some.get(i, np.zeros(0, int)).tolist())
        if share >= 0.99:
            assert looked < 0.5 * scores.size
    every, some = bucket.candidates(q, scores.max() * np.full(60, 10.0))
    assert not len(every) and not some  # beyond any length: the bucket is skipped


def test_nulls_ties_repeats_and_other_lengths(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, 1, [1.0, 0.0]), (1, 1, [1.0, 0.0]), (2, 1, [1.0, 0.0]), (2, 1, [1.0, 0.0]),
            (3, 2, [0.9, 0.0]), (4, 2, [0.9, 0.0]), (4, 2, [0.9, 0.0]), (4, 3, [0.95, 0.0]),
            (5, 2, [0.7, 0.0]), (6, None, [1.0, 0.0]), (7, 2, None), (8, 2, [nan, 0.0]), (9, 2, [1.0, None]),
            (11, 2, [inf, 0.0]), (12, 2, [1e308, 0.0]), (13, 2, [1.0, 0.0, 0.0]), (None, 2, [1.0, 0.0]),
            (14, 2, [2.0, 0.0]), (20, 1, [0.0, 0.0]), (30, 5, [1.0, 1.0]), (15, 5, [-1.0, -1.0]),
            (40, 7, [3.0, 1.0, 1.0]), (16, 7, [1.0, 1.0, 1.0]), (0, 9, [0.99, 0.0]), (50, 8, []), (51, 8, []),
            (52, 9, [])]
    want = brute(rows, lambda i: i % 10 == 0)
    assert run(spark, rows) == want
    assert run(spark, rows, bucket_rows=2) == want
    assert [r for r in want if r[:2] == (0, 1)] and not [r for r in want if r[1] == 15]
    assert [r[3:] for r in want if r[0] == 50] == [(52, 0, 0)]
    assert run(spark, rows[:1]) == [] and run(spark, [(1, 1, [1.0])]) == []
    assert run(spark, spark.createDataFrame([], SCHEMA)) == []


def test_clashing_names_and_parameters(spark):
    rows = clustered(200)
    df = spark.createDataFrame(rows, SCHEMA).toDF("id", "class", "v")
    df = df.withColumns({c: F.lit(1) for c in ("vec_id", "label", "vector", "rank", "dim", "score", "slot",
                                               "anchor_id", "_v", "_class", "_length")})
    got = run(spark, df, "id % 10 = 0", id_col="id", label_col="class", vec_col="v", positives=2,
              negatives=3, low=50, bucket_rows=40)
    assert got == brute(rows, lambda i: i % 10 == 0, 2, 3, 50)


def test_numbers_beyond_double_precision_and_beyond_a_long(spark):
    rng = np.random.default_rng(6)
    for size in (1e6, 1e9, 3e15, 1e200):
        rows = [(i, i % 2, (size * (1 + rng.random(4))).tolist()) for i in range(60)]
        assert run(spark, rows, bucket_rows=20) == brute(rows, lambda i: i % 10 == 0)


def test_hot_group_of_copies_and_one_label(spark):
    same = [0.3, -0.4, 0.5]
    rows = [(i, 3 if i % 4 else i % 7, same if i % 3 == 0 else [0.1 * (i % 11), -0.2, 0.3]) for i in range(900)]
    assert run(spark, rows, "vec_id % 100 = 0", bucket_rows=64) == brute(rows, lambda i: i % 100 == 0)
    one = [(i, 1, v) for i, _, v in rows]
    assert run(spark, one) == []


def test_rows_found_stay_near_the_number_asked_for(spark):
    """Before they are merged, whatever the number of buckets."""
    rows = clustered(4000, 8, 2)
    df = neg.usable(spark.createDataFrame(rows, SCHEMA), F.col("vec_id") % 100 == 0, 256, "vec_id", "label",
                    "embedding")
    seen, real = [], neg.found_between

    def counted(*args):
        out = real(*args)
        seen.append(out.count())
        return out

    anchors = df.where("anchor").select(F.col("vec_id").alias("anchor_id"), F.lit(0).cast("long").alias(
        "anchor_key"), "label", "vector")
    ranges = anchors.select("anchor_id", "anchor_key", F.lit(0).alias("slot"), F.lit(neg.LEAST).alias("floor"),
                            F.lit(neg.MOST).alias("top"))
    index, ranks = neg.build_index(df, 40)
    assert ranks >= 90
    neg.found_between = counted
    try:
        found = neg.search(index, ranks, anchors, ranges, 5, same=True)
    finally:
        neg.found_between = real
    assert found.count() == 40 * 5
    assert len(seen) == 4 and max(seen) <= 40 * 5 * 4  # 90 buckets or more might find 18,000
