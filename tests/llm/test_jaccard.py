import numpy as np
import pytest

from cartwise.llm import jaccard


def classes(docs):
    """{id: (n_shingles, component)} by comparing all pairs."""
    sets = {}
    for i, text in docs:
        w = (text or "").encode().lower().split()
        sets[i] = {tuple(w[k:k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())
    parent = {i: i for i in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and sets[a] and sets[b]:
                both = len(sets[a] & sets[b])
                if 100 * both >= 75 * (len(sets[a]) + len(sets[b]) - both):
                    x, y = sorted((root(a), root(b)))
                    parent[y] = x
    return {i: (len(sets[i]), root(i)) for i in ids}


def corpus(seed, families=12, n=12):
    """Families of edited copies, similar at all degrees around the threshold."""
    rng = np.random.default_rng(seed)
    docs = []
    for _ in range(families):
        base = [str(x) for x in rng.integers(0, 500, int(rng.integers(1, 90)))]
        for _ in range(int(rng.integers(1, n))):
            own = list(base)
            for _ in range(int(rng.integers(0, 4))):
                at = int(rng.integers(0, len(own)))
                own[at:at + int(rng.integers(0, 2))] = [str(x) for x in rng.integers(0, 500, int(rng.integers(0, 6)))]
                own = own or ["x"]
            docs.append(" ".join(own))
    line = "this same line stands in nearly every one of these texts "
    return docs + [line + d for d in docs[:40]] + ["A b", "a B", "a  b c", "", "a b"]


@pytest.mark.parametrize("seed", [1])
def test_classes_against_all_pairs(spark, seed):
    docs = list(enumerate(corpus(seed)))
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.linked(df).collect()}
    assert got == classes(docs)


def test_without_the_strong_start(spark, monkeypatch):
    """The last round alone must find every link too."""
    monkeypatch.setattr(jaccard, "verify", _only_last(jaccard.verify))
    docs = list(enumerate(corpus(5, families=8)))
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.linked(df).collect()}
    assert got == classes(docs)


def _only_last(verify):
    calls = []

    def late(edges, texts):
        calls.append(1)
        return verify(edges if len(calls) > 2 else edges.limit(0), texts)

    return late


def test_hub_with_more_members_than_one_group_holds(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "HUB_MEMBERS", 5)
    base = [f"w{i}" for i in range(60)]
    docs = [(i, " ".join(base[:i % 60] + [f"x{i}"] + base[i % 60:])) for i in range(60)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.linked(df).collect()} == classes(docs)


def test_copies_that_do_not_link_meet_once(spark, monkeypatch):
    """Copies below the similarity share hundreds of shingles, and make one pair each,
    not one for every shingle."""
    made, met = [], jaccard._met

    def counted(index):
        rows = met(index)
        made.append((rows.count(), rows.distinct().count()))
        return rows

    monkeypatch.setattr(jaccard, "_met", counted)
    monkeypatch.setattr(jaccard, "SAMPLE_SHARE", 2.0)  # none is frequent among so few texts
    rng, docs = np.random.default_rng(3), []
    base = [f"w{i}" for i in range(400)]
    for k in range(16):
        own = list(base)
        for at in rng.choice(400, 16 if k % 4 else 4, replace=False):
            own[at] = f"x{k}-{at}"
        docs.append((k, " ".join(own)))
    df = spark.createDataFrame(docs, "doc_id long, text string")
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.linked(df).collect()} == classes(docs)
    rows, pairs = made[0]
    assert pairs > 20 and rows <= 2 * pairs


def test_edge_cases(spark):
    p = "one two three four five six seven"
    rows = [(5, p, 1, "k"), (3, p.upper(), 1, None), (3, p.upper(), 1, None), (None, p, 1, None),
            (9, None, 1, None), (8, "", 1, None), (7, "lone", 1, None), (None, "odd", None, None),
            (6, "z " * 30_000, 1, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_shingles int, g string")
    got = jaccard.linked(df).collect()
    assert len(got) == 9 and got[0].__fields__ == ["doc_id", "text", "g", "n_shingles", "component_id"]
    by = {(r.doc_id, r.text): (r.n_shingles, r.component_id) for r in got}
    assert by[5, p] == (3, 3) and by[3, p.upper()] == (3, 3) and by[None, p] == (3, 3)
    assert by[9, None] == (0, 9) and by[8, ""] == (0, 8) and by[7, "lone"] == (1, 7)
    assert by[None, "odd"] == (1, None) and by[6, rows[8][1]] == (1, 6)
    kept = jaccard.deduplicated(df).collect()
    assert sorted((r.doc_id or -1) for r in kept) == [-1, 3, 3, 6, 7, 8, 9]
    assert jaccard.linked(df.limit(0)).count() == 0
