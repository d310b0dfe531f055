import hashlib
import itertools
from collections import Counter

import numpy as np
import pytest

from cartwise.llm import suffixes as sx
from cartwise.llm import windows as win


def naive(docs, size):
    seen = Counter(b[i:i + size] for b in docs for i in range(len(b) - size + 1))
    out = []
    for b in docs:
        cover = bytearray(len(b))
        for i in range(len(b) - size + 1):
            if seen[b[i:i + size]] > 1:
                cover[i:i + size] = b"\1" * size
        spans = [(len(list(g)), k) for k, g in itertools.groupby(cover)]
        kept = bytes(x for x, c in zip(b, cover) if not c)
        out.append((len(b), len(b) - len(kept), sum(k for _, k in spans), kept))
    return out


@pytest.mark.parametrize("text", [b"banana", b"", b"a", b"aaaaaaa" * 9, b"\0\0\0\0a\0\0", b"abab" * 40,
                                  bytes(np.random.default_rng(1).integers(97, 99, 3000, dtype=np.uint8))])
def test_suffix_array_and_common_prefixes(text):
    arr = np.frombuffer(text, dtype=np.uint8)
    if not len(arr):
        return
    sa = sx.suffix_array(arr)
    assert sa.tolist() == sorted(range(len(text)), key=lambda i: text[i:])
    got = sx.common_prefixes(arr, sa, 30)
    for k in range(1, len(sa)):
        a, b = text[sa[k - 1]:], text[sa[k]:]
        want = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
        assert got[k] == min(30, want)


def corpus(seed, n=60):
    rng = np.random.default_rng(seed)
    phrase = ["".join(rng.choice(list("abé "), 30)) for _ in range(6)]
    docs = []
    for _ in range(n):
        parts = ["".join(rng.choice(list("abcdefgh "), int(rng.integers(0, 60)))) for _ in range(3)]
        parts.insert(int(rng.integers(0, 3)), phrase[int(rng.integers(0, 6))])
        docs.append("".join(parts))
    return docs + ["xy" * 100, "q" * 90, "", "short", docs[0], docs[0], "z" * 12, "z" * 13]


@pytest.mark.parametrize("part_bytes,chunk", [(1 << 21, 3 << 20), (150, 64)])
def test_removal_against_brute_force(spark, monkeypatch, part_bytes, chunk):
    monkeypatch.setattr(win, "CHUNK_BYTES", chunk)  # long texts are cut into pieces
    monkeypatch.setattr(sx, "anywhere", lambda size, f=sx.anywhere: f(size, part_bytes))
    docs = corpus(part_bytes)
    df = spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string").repartition(3)
    rows = {r.doc_id: r for r in sx.dedup_bytes(df, size=12, gram=4).collect()}
    for i, want in enumerate(naive([d.encode() for d in docs], 12)):
        r = rows[i]
        assert (r.n_bytes, r.n_removed, len(r.spans), bytes(r.kept)) == want
        assert r.text == docs[i]


def test_query_on_whole_fixture(spark, texts):
    from conftest import SF_SMALL

    rows = {r.doc_id: tuple(r)[1:] for r in sx.op5_suffixes(spark, SF_SMALL).collect()}
    ids = sorted(texts)
    for i, want in zip(ids, naive([(texts[i] or "").encode() for i in ids], 200)):
        assert rows[i] == (*want[:3], hashlib.sha256(want[3]).hexdigest())


def test_edge_cases(spark):
    a, b = "p" * 5 + "0123456789abcdef", "0123456789abcdef" + "s" * 5
    rows = [(1, a, 5, "k"), (None, b, None, None), (2, None, 5, None), (3, "u" * 9, 5, None),
            (3, "other text with the same id", 5, None), (4, "lone text that is repeated as a row", 5, "x"),
            (4, "lone text that is repeated as a row", 5, "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_bytes int, part string")
    got = sx.dedup_bytes(df, size=12, gram=4).collect()
    by = {(r.doc_id, r.text): r for r in got}
    assert len(got) == 7 and got[0].__fields__[:3] == ["doc_id", "text", "part"]
    assert bytes(by[1, a].kept) == b"ppppp" and bytes(by[None, b].kept) == b"sssss"
    assert by[2, None].n_bytes == 0 and bytes(by[2, None].kept) == b""
    assert by[4, rows[5][1]].n_removed == 0
    assert sx.dedup_bytes(df.limit(0), size=12, gram=4).count() == 0
