from pyspark.sql import functions as F

from cartwise.llm import mixing


def filled(sizes, weights, share, epochs):
    """Targets by repeated clamping and resharing."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    left, clamped = share * sum(sizes.values()), {}
    while True:
        open_ = [s for s in order if s not in clamped]
        total = sum(w[s] for s in open_)
        over = [s for s in open_ if left * w[s] / total > epochs * sizes[s]] if open_ else []
        if not over:
            return {**clamped, **{s: left * w[s] / total for s in open_}}
        for s in over:
            clamped[s] = epochs * sizes[s]
        left = share * sum(sizes.values()) - sum(clamped.values())


def test_targets_match_iterated_clamping(spark):
    sizes = {"b": 10, "a": 4, "é": 1000, None: 7, "A": 30, "z": 0}
    df = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    for weights, share in (((5, 2, 1), 1.5), ((1, 1), 2.0), ((1, 100), 0.3)):
        got = {r.source: r.target for r in mixing.source_targets(df, weights, share, 2).collect()}
        want = filled(sizes, weights, share, 2)
        assert all(abs(got[s] - want[s]) < 1e-6 for s in sizes)


def rows(spark, extra=()):
    data = [(i, "w " * (i % 9), ["s1", "s2", None][i % 7 % 3], "x") for i in range(300)]
    return spark.createDataFrame([*data, *extra], "doc_id long, text string, source string, size string")


def test_taken_words_meet_the_targets(spark):
    extra = [(None, "one two", "s1", "x"), (7, None, "s4", "x"), (8, "", "s4", None),
             (3, "w w w", "s2", "x"), (3, "w w w", "s2", "x"), (900, "long " * 200_000, "s3", "x")]
    df = rows(spark, extra)
    got = mixing.mix(df).toPandas()
    assert len(got) == 306 and list(got.columns).count("size") == 1
    for _, g in got.groupby("source", dropna=False):
        assert abs(g.taken.sum() - g.target.iloc[0]) <= 0.5
        assert g["size"].sum() == g.source_size.iloc[0]
    assert (got.taken <= 2 * got["size"]).all() and (got.taken >= 0).all()
    again = mixing.mix(df.repartition(7)).toPandas()
    key = ["doc_id", "size", "taken"]
    assert got[key].sort_values(key).values.tolist() == again[key].sort_values(key).values.tolist() \
        or got[key].fillna(-1).sort_values(key).values.tolist() == \
        again[key].fillna(-1).sort_values(key).values.tolist()
    assert mixing.mix(df.limit(0)).count() == 0


def test_mixture_holds_the_words_taken(spark):
    df = rows(spark).drop("size").withColumn("n_chars", F.length("text").cast("long"))
    out = mixing.mixture(df)
    assert out.columns == df.columns
    taken = mixing.mix(df).groupBy("source").agg(F.sum("taken").alias("t"))
    words = out.groupBy("source").agg(F.sum(mixing.word_count(F.col("text"))).alias("t"))
    assert {tuple(r) for r in taken.collect()} == {tuple(r) for r in words.collect()}
    assert out.where("n_chars != length(text)").count() == 0


def test_only_empty_texts(spark):
    df = spark.createDataFrame([(1, None, "a"), (2, "", "b")], "doc_id long, text string, source string")
    assert [r.taken for r in mixing.mix(df).collect()] == [0, 0]
    assert mixing.mixture(df).count() == 0
