import hashlib
import random

import pytest
import sentencepiece

from cartwise.llm import pieces


@pytest.fixture(scope="module")
def model():
    return sentencepiece.SentencePieceProcessor(model_file=pieces.default_model())


@pytest.fixture(scope="module")
def encoder():
    return pieces.Encoder(pieces.Vocabulary.load(pieces.default_model()))


def test_random_texts_encode_as_the_library_does(model, encoder):
    rng = random.Random(4)
    alphabet = sorted(encoder.alphabet)
    for _ in range(4000):
        text = "".join(rng.choice(rng.choice([" ", "\n", "ab", "the ", "▁", "é😀\x00\x7f", "  ", "0123",
                                              "　", " ", alphabet])) for _ in range(rng.randint(0, 40)))
        ids = model.encode(text)
        assert encoder.encode(text) == ids
        assert encoder.decode(ids) == model.decode(ids)


def test_random_ids_decode_as_the_library_does(model, encoder):
    rng = random.Random(5)
    for _ in range(2000):
        ids = [rng.choice([rng.randint(1, 258), rng.randint(1, 31999)]) for _ in range(6)]
        assert encoder.decode(ids) == model.decode(ids)


def test_small_memories_change_nothing(model, monkeypatch):
    monkeypatch.setattr(pieces, "CACHE_PARTS", 3)
    monkeypatch.setattr(pieces, "CACHE_PAIRS", 5)
    encoder = pieces.Encoder(pieces.Vocabulary.load(pieces.default_model()))
    text = "some words of a text that is longer than the memory"
    assert encoder.encode(text) == model.encode(text)


def test_remembered_characters_are_bounded(model, monkeypatch):
    """Texts without spaces are one part each; scripts without spaces, many long ones."""
    monkeypatch.setattr(pieces, "CACHE_PARTS", 200)
    encoder = pieces.Encoder(pieces.Vocabulary.load(pieces.default_model()))
    rng = random.Random(6)
    alphabet = sorted(encoder.alphabet)

    def held():
        return sum(len(k) + len(v) for d in (encoder.known, encoder.older) for k, v in d.items())

    most = 2 * (200 * pieces.PART_ROOM + 10 * pieces.LONGEST)
    for n in (5, 40, 48, 49, 400, 60_000):
        for _ in range(300 if n < 100 else 3):
            text = "".join(rng.choices(alphabet[200:], k=n)) if n % 2 else "".join(rng.choices("abcdef", k=n))
            encoder.encoded(text)
            assert held() <= most
    assert all(len(k) <= pieces.LONGEST for k in encoder.known)
    text = "x" * 100_000 + "\x00" + "é😀" * 10_000
    assert encoder.encode(text) == model.encode(text)


def test_odd_parts_forgotten_within_a_text(model, monkeypatch):
    """A text with more odd parts than are remembered decodes as ever."""
    monkeypatch.setattr(pieces, "CACHE_PARTS", 4)
    encoder = pieces.Encoder(pieces.Vocabulary.load(pieces.default_model()))
    bad = [f"{chr(0xE000 + i)}{'q' * (i % 60)}" for i in range(40)]
    for text in (" ".join(bad), " ".join(bad[:6] + ["plain"] * 20), bad[0] + "z" * 60, "ok " + bad[5], "▁x ok"):
        ids, decoded = encoder.encoded(text)
        assert list(map(int, ids.split(","))) == model.encode(text)
        assert decoded == model.decode(model.encode(text))


def test_query_against_the_library(spark, model, texts):
    from conftest import SF_SMALL

    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    rows = {r.doc_id: tuple(r)[1:] for r in pieces.op9_pieces(spark, SF_SMALL).collect()}
    assert len(rows) == len(texts)
    for i, text in texts.items():
        ids = model.encode(text or "")
        assert rows[i] == (len(ids), sha(",".join(map(str, ids))), sha(model.decode(ids)))


def test_edge_cases(spark, model):
    long = "word " * 60_000 + "x" * 20_000 + " " * 5000
    rows = [(1, None, 1, "k"), (2, "", 1, None), (None, "a  b", 1, None), (3, " ", 1, None),
            (3, " ", 1, None), (4, long, None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids int, x string")
    out = pieces.encode(df, pieces.default_model(), outputs=("n_tokens", "ids", "decoded"))
    got = out.collect()
    assert got[0].__fields__ == ["doc_id", "text", "x", "n_tokens", "ids", "decoded"] and len(got) == 6
    for r in got:
        ids = model.encode(r.text or "")
        assert r.ids == ids and r.n_tokens == len(ids) and r.decoded == model.decode(ids)
    back = pieces.decode(out.drop("decoded"), pieces.default_model()).collect()
    assert [r.decoded for r in back] == [r.decoded for r in got]
    assert pieces.encode(df.limit(0), pieces.default_model()).count() == 0
