import itertools

import numpy as np
from pyspark.sql import functions as F

from cartwise.llm import toxicity as tx


def test_marginals_are_those_of_all_labellings():
    rng = np.random.default_rng(3)
    trans = rng.normal(size=(2, 2))
    emissions = np.array([*rng.normal(size=5), np.nan, *rng.normal(size=3), np.nan, np.nan, 0.3])
    begin, length = tx.chains(emissions)
    assert length.tolist() == [5, 3, 1]
    got = tx.marginals(emissions, begin, length, trans)
    for b, n in zip(begin, length):
        total, ones = 0.0, np.zeros(n)
        for ys in itertools.product((0, 1), repeat=int(n)):
            s = sum(emissions[b + i] * y for i, y in enumerate(ys))
            s += sum(trans[a, c] for a, c in zip(ys, ys[1:]))
            total += np.exp(s)
            ones += np.exp(s) * np.array(ys)
        assert np.allclose(got[b:b + n], ones / total)


def test_pairwise_marginals_and_normalisers_are_those_of_all_labellings():
    two = tx.sweeps(np.zeros(2), np.array([0]), np.array([2]), np.array([[2.0, 0.0], [0.0, 2.0]]))
    assert two.pairs(np.array([0]))[1, 1] == np.exp(2) / (2 * np.exp(2) + 2)  # .44, not .25
    rng = np.random.default_rng(4)
    trans = rng.normal(size=(2, 2))
    emissions = np.array([*rng.normal(size=4), np.nan, *rng.normal(size=5), np.nan, 0.7])
    begin, length = tx.chains(emissions)
    found = tx.sweeps(emissions, begin, length, trans)
    want, log_z = np.zeros((2, 2)), 0.0
    for b, n in zip(begin, length):
        total, pairs = 0.0, np.zeros((2, 2))
        for ys in itertools.product((0, 1), repeat=int(n)):
            s = np.exp(sum(emissions[b + i] * y for i, y in enumerate(ys))
                       + sum(trans[a, c] for a, c in zip(ys, ys[1:])))
            total += s
            for a, c in zip(ys, ys[1:]):
                pairs[a, c] += s
        want, log_z = want + pairs / total, log_z + np.log(total)
    word = ~np.isnan(emissions)
    assert np.allclose(found.pairs(np.flatnonzero(word[1:] & word[:-1])), want)
    assert np.isclose(found.log_z, log_z)


def _tokens(seed):
    rng = np.random.default_rng(seed)
    words, n = 6, 40
    stop_word = words - 1
    tokens = rng.integers(0, words, n)
    stops = np.arange(words) == stop_word
    feats = np.zeros((words, tx.WIDTH), dtype=np.int64)
    for i in range(words - 1):
        feats[i, :2] = [i + 1, 6 + i % 2]
    stop = stops[tokens]
    target = np.where(stop, 0.0, rng.integers(0, 2, n))
    begin, length = tx.chains(np.where(stop, np.nan, 0.0))
    return tx.Tokens(tokens, feats, stop, target, begin, length), rng


def test_gradient_equals_finite_differences():
    for seed in (1, 2):
        data, rng = _tokens(seed)
        w, bias, trans = rng.normal(size=8), -0.3, rng.normal(size=(2, 2))
        w[0] = 0.0
        _, (gw, gb, gt) = tx.likelihood(data, w, bias, trans)
        h = 1e-6

        def slope(f):
            return (f(h) - f(-h)) / (2 * h)

        for i in range(1, 8):
            step = np.zeros(8)
            step[i] = 1.0
            assert np.isclose(gw[i], slope(lambda x: tx.likelihood(data, w + x * step, bias, trans)[0]), atol=1e-5)
        assert np.isclose(gb[0], slope(lambda x: tx.likelihood(data, w, bias + x, trans)[0]), atol=1e-5)
        for a, b in itertools.product((0, 1), repeat=2):
            step = np.zeros((2, 2))
            step[a, b] = 1.0
            assert np.isclose(gt[a, b], slope(lambda x: tx.likelihood(data, w, bias, trans + x * step)[0]), atol=1e-5)


def test_sample_is_bounded_in_documents_and_bytes_and_holds_whole_texts(spark):
    rows = [(i, f"w{i} " * (2000 if i % 10 == 0 else 20)) for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i, _ in rows], "doc_id long, toxic int")
    texts = dict(rows)
    got = tx._sample(docs, labels, 50, 1 << 30, "doc_id", "text", "toxic")
    assert len(got) == 100 and {t for t, _ in got} <= set(texts.values())
    small = tx._sample(docs, labels, 50, 30_000, "doc_id", "text", "toxic")
    for y in (0, 1):
        mine = [t for t, label in small if label == y]
        assert mine and set(mine) <= set(texts.values())
        assert sum(map(len, mine)) <= 30_000 or len(mine) == 1
    assert len(tx._sample(docs, labels, 50, 1, "doc_id", "text", "toxic")) == 2


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    labels = spark.read.parquet(f"{sf}/labels.parquet").select("doc_id", "toxic")
    scored = tx.score(docs, tx.fitted(spark, sf)).join(labels, "doc_id")
    held = scored.where(tx.held_out(F.col("doc_id"))).toPandas()
    assert (held.predicted == held.toxic).mean() > 0.97
    assert held[held.toxic == 1].predicted.mean() > 0.85
    assert held[held.toxic == 0].predicted.mean() < 0.02


MODEL = tx.Model({"idiot": 30.0, "lowei*": 30.0}, -10.0, np.zeros((2, 2)), (-4.0, 4.0, 4.0))


def test_spans_and_edge_cases(spark):
    text = "Ah, 😀 IDIOT loweian. fine\nidiot"
    rows = [(1, text, 5), (2, None, 5), (3, "", None), (4, "...", 5), (1, text, 5),
            (None, "fine " * 100_000, 5)]
    df = spark.createDataFrame(rows, "doc_id long, text string, score int")
    got = tx.score(df, MODEL).collect()
    assert len(got) == 6 and got[0].__fields__ == ["doc_id", "text", "score", "predicted", "toxic_spans"]
    spans = [(s.start, s.end) for s in got[0].toxic_spans]
    assert [text[a:b] for a, b in spans] == ["IDIOT loweian", "idiot"]
    assert got[0].predicted == 1 and got[4] == got[0]
    assert [r.predicted for r in got[1:4]] == [0, 0, 0] and got[1].score == got[3].score
    assert got[5].predicted == 0 and all(0 <= r.score <= 1 for r in got)
    assert tx.score(df.limit(0), MODEL).count() == 0


def test_training_without_both_labels(spark):
    docs = spark.createDataFrame([(1, "a b", "x"), (2, "c", "y")], "doc_id long, text string, toxic string")
    labels = spark.createDataFrame([(1, 0, 9), (2, None, 9)], "doc_id long, toxic int, text int")
    assert tx.train(docs, labels.limit(0)).constant == 0.0
    model = tx.train(docs, labels)
    assert model.constant == 0.0
    assert [r.predicted for r in tx.score(docs, model).collect()] == [0, 0]


def test_held_out_rows_do_not_teach(spark):
    rows = [(i, "bad stuff here" if i % 2 else "good stuff here") for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i, _ in rows], "doc_id long, toxic int")
    held = {r.doc_id for r in docs.where(tx.held_out(F.col("doc_id"))).collect()}
    import zlib
    assert held == {i for i, _ in rows if zlib.crc32(str(i).encode()) % 5 == 0}
    assert not tx.held_out(F.lit(None).cast("long")) is None
    assert docs.select(tx.held_out(F.lit(None).cast("long")).alias("h")).first().h is False


def test_learns_from_whole_texts(spark):
    import random

    rng = random.Random(3)
    letters = "abcdefghij"
    words = ["".join(rng.choices(letters, k=6)) for _ in range(40_000)]

    def text(n, mark=""):
        out = rng.choices(words, k=n)
        return " ".join(w + "." if i % 12 == 11 else w for i, w in enumerate(out)) + f" {mark} {out[0]}."

    # the marked word comes after more than 2,000 words
    rows = [(i, text(2100 + i, "zworst" if i % 2 else "")) for i in range(120)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i, _ in rows], "doc_id long, toxic int")
    model = tx.train(docs, labels)
    got = {r.doc_id: r for r in tx.score(docs, model).collect()}
    assert all(got[i].predicted == i % 2 for i, _ in rows)
    assert all(rows[1][1][s.start:s.end] == "zworst" for s in got[1].toxic_spans) and got[1].toxic_spans
