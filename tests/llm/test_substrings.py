import numpy as np
import pytest

from cartwise.llm import substrings as ss
from cartwise.llm import windows as win


def naive(docs, size):
    """docs: (id, text) in order; what is kept of each."""
    seen, out = set(), []
    for _, text in docs:
        words = (text or "").encode().split()
        cover = [False] * len(words)
        for i in range(len(words) - size + 1):
            key = tuple(words[i:i + size])
            if key in seen:
                cover[i:i + size] = [True] * size
            seen.add(key)
        out.append((len(words), sum(cover), b" ".join(w for w, c in zip(words, cover) if not c).decode()))
    return out


def corpus(seed, n=80):
    rng = np.random.default_rng(seed)
    vocab = ["the", "of", "é x", "B,", "b", "x" * 40]
    phrase = [" ".join(rng.choice(vocab, 9)) for _ in range(5)]
    docs = []
    for _ in range(n):
        parts = [" ".join(str(x) for x in rng.integers(0, 99, int(rng.integers(0, 12)))) for _ in range(2)]
        parts.insert(1, phrase[int(rng.integers(0, 5))])
        docs.append(str(rng.choice([" ", "\n", "\t\r\n", "  "])).join(parts))
    return docs + ["la " * 60, "la la la", "", " \n ", docs[3], docs[3]]


@pytest.mark.parametrize("chunk", [3 << 20, 50])
def test_removal_against_brute_force(spark, monkeypatch, chunk):
    monkeypatch.setattr(win, "CHUNK_BYTES", chunk)
    docs = list(enumerate(corpus(chunk)))
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    rows = {r.doc_id: r for r in ss.dedup_words(df, size=6, gram=2).collect()}
    for (i, text), want in zip(docs, naive(docs, 6)):
        r = rows[i]
        assert (r.n_words, r.n_removed, r.kept) == want and r.text == text
        assert sum(s.end - s.start for s in r.spans) == r.n_removed


def test_splitting_is_on_ascii_white_space_only():
    data, begin, end, first = ss.split_words([b"  a\x0bb\xc2\xa0c ", b"", b"d", b"e  f"])
    assert [data[a:b] for a, b in zip(begin, end)] == [b"a", b"b\xc2\xa0c", b"d", b"e", b"f"]
    assert first.tolist() == [0, 2, 2, 3, 5]


def test_window_numbers_are_exact():
    seq = np.random.default_rng(2).integers(0, 2, 400)
    for size in (1, 2, 5, 7, 20):
        got = ss.window_numbers(seq, size)
        runs = [tuple(seq[i:i + size]) for i in range(len(seq) - size + 1)]
        pairs = set(zip(runs, got[:len(runs)].tolist()))
        assert len(pairs) == len(set(runs)) == len({g for _, g in pairs})


def test_edge_cases(spark):
    p = "one two three four five six"
    rows = [(None, p + " n", 1, "k"), (1, p + " a", 1, None), (2, None, 1, None), (3, "", None, None),
            (4, "w " * 20_000, 1, None), (5, "only once said words here now", 1, None),
            (5, "only once said words here now", 1, None), (6, "five", 1, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, kept int, start string")
    got = ss.dedup_words(df, size=6, gram=2).collect()
    by = {r.doc_id: r for r in got}
    assert len(got) == 8 and got[0].__fields__[:3] == ["doc_id", "text", "start"]
    assert by[None].n_removed == 0 and by[1].kept == "a"  # a missing id comes first
    assert by[2].n_words == 0 and by[3].kept == ""
    assert by[4].n_removed == 20_000 - 1 and by[5].n_removed == 0
    assert ss.dedup_words(df.limit(0), size=6, gram=2).count() == 0
