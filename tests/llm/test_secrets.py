import hashlib
import random
import re
import string
import time

from pyspark.sql import functions as F

from cartwise.llm import secrets

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                    re.I | re.A)
ACCESS, HEX = re.compile("AKIA[A-Z0-9]+"), re.compile("[0-9a-f]+")


def base(text):
    text = text or ""
    found = [[m for m in ASSIGN.finditer(text) if len(m[2]) >= 6],
             [m for m in ACCESS.finditer(text) if len(m[0]) >= 20],
             [m for m in HEX.finditer(text) if len(m[0]) >= 24]]
    spans = sorted((m.start(), k, m.end()) for k, ms in enumerate(found) for m in ms)
    names = [f"{secrets.KINDS[k]}:{a}:{b}" for a, k, b in spans]
    return (*map(len, found), hashlib.sha256(",".join(names).encode()).hexdigest()), names


def noisy(seed, n=300):
    rng = random.Random(seed)
    bits = ["password", "PassWd", "secret", "token", "api_key", "APIKEY", "apiKkey", "=", ":", " ", "  ",
            '"', "'", "AKIA", "AKIA" + "Z9" * 8, "abc", "abcdef12", "0123456789abcdef" * 2, "deadbeef" * 3,
            "😀", "\n", ".", "-", "é", "tokKen=", "x" * 30, "A1" * 12]
    return ["".join(rng.choice(bits) for _ in range(rng.randint(0, 25))) for _ in range(n)]


def test_base_spans_against_brute_force(spark):
    texts = [*noisy(1), None, "", "a" * 300_000 + " token=abcdef", "AKIA" * 6]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = secrets.find_secrets(df).withColumn("names", secrets.spans_text(F.col("base_found")))
    for r in rows.collect():
        want, names = base(texts[r.doc_id])
        assert r.names == ",".join(names), texts[r.doc_id]
        assert (r.n_assign, r.n_access, r.n_hex) == want[:3]
        assert set(names) <= {f"{secrets.KINDS[s.k]}:{s.start}:{s.end}" for s in r.found}


def test_query_on_whole_fixture(spark):
    sf = "/root/testdata/sf0.01"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = secrets.op10_secrets(spark, sf).collect()
    assert len(rows) == len(texts)
    for r in rows:
        assert (r.n_assign, r.n_access, r.n_hex, r.base_sha256) == base(texts[r.doc_id])[0]


def test_battery_reports_random_strings_and_no_others(spark):
    rng = random.Random(9)
    keys = ["".join(rng.choice(string.ascii_letters + string.digits) for _ in range(40)) for _ in range(40)]
    keys = [k for k in keys if re.search(r"\d", k)]
    plain = ["aaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaa1", "1111111111111111111111111111a", "word" * 9 + "1",
             "abababababababababababababababab1", "Verylongwordwithoutanydigitsinside"]
    df = spark.createDataFrame([(i, f"see {k} here") for i, k in enumerate([*keys, *plain])],
                               "doc_id long, text string")
    n = {r.doc_id: r.n_random for r in secrets.find_secrets(df).collect()}
    assert sum(n[i] for i in range(len(keys))) >= 0.95 * len(keys)
    assert sum(n[len(keys) + i] for i in range(len(plain))) == 0


def test_redaction(spark):
    rows = [(1, 'pw: token="abcdefgh" end', 24, "k"), (2, None, None, None), (3, "", 0, None),
            (4, "😀 0123456789abcdef01234567é", 27, None), (5, "clean", 5, None), (5, "clean", 5, None),
            (None, "secret=0123456789abcdef01234567", 31, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_chars long, found string")
    # rows come in no order: those with an id by it, then the one without
    got = sorted(secrets.redact(df).collect(), key=lambda r: (r.doc_id is None, r.doc_id))
    assert got[0].__fields__ == df.columns
    text = [r.text for r in got]
    assert text == ['pw: [SECRET]" end', None, "", "😀 [SECRET]é", "clean", "clean", "[SECRET]"]
    assert [r.n_chars for r in got][3:6] == [11, 5, 5]
    assert secrets.redact(df.limit(0)).count() == 0


def test_letter_runs_mixed_runs_and_rests_of_runs_are_tested(spark):
    rng = random.Random(12)
    key = lambda n, abc: "".join(rng.choice(abc) for _ in range(n))
    letters, both = string.ascii_letters, string.ascii_letters + string.digits
    only = [key(40, letters) for _ in range(20)]
    mixed = [key(20, both) + "/" + key(19, both) for _ in range(20)]
    rest = [key(40, both) for _ in range(20)]
    rows = [f"see {k} here" for k in only] + [f"see sk-{k} here" for k in mixed]
    rows += [f"see {k}_token=abcdefgh here" for k in rest]
    df = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    got = {r.doc_id: [rows[r.doc_id][s.start:s.end] for s in r.found if s.k == 3]
           for r in secrets.find_secrets(df).collect()}
    hits = [any(k in span for span in got[i]) for i, k in enumerate([*only, *mixed, *rest])]
    assert [sum(hits[a:a + 20]) >= 18 for a in (0, 20, 40)] == [True] * 3


def test_running_totals_and_highest(spark):
    from cartwise.llm.common import highest_before, let, totals_before

    rng = random.Random(1)
    rows = [([rng.randrange(1, 9) for _ in range(n)],) for n in (0, 1, 2, 63, 64, 65, 128, 500)]
    df = spark.createDataFrame(rows, "x array<long>").select(
        "x", let(F.col("x"), totals_before).alias("t"), let(F.col("x"), highest_before).alias("h"))
    for r in df.collect():
        assert r.t == [sum(r.x[:i]) for i in range(len(r.x))]
        assert r.h == [max([0, *r.x[:i]]) for i in range(len(r.x))]


def test_redaction_against_a_loop(spark):
    texts = [*noisy(5), None, "", "no secret", "token=abcdef", "😀 token: abcdef\n😀"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumn(
        "n_chars", F.coalesce(F.char_length("text"), F.lit(0)))
    found = {r.doc_id: r.found for r in secrets.find_secrets(df).collect()}
    out = {r.doc_id: r for r in secrets.redact(df).collect()}
    for i, text in enumerate(texts):
        want, at = [], 0
        for s in found[i]:
            if s.start >= at:
                want += [text[at:s.start], "[SECRET]"]
            at = max(at, s.end)
        assert out[i].text == (text if not found[i] else "".join(want) + text[at:])
        assert out[i].n_chars == len(out[i].text or "")


def test_one_long_text_in_linear_time(spark):
    def seconds(n):
        rng = random.Random(n)
        word = lambda k: "".join(rng.choice(string.ascii_letters + string.digits) for _ in range(k))
        text = " ".join(f"token=abc{i}def {word(24)}-" for i in range(n // 2))
        df = spark.createDataFrame([(1, text)], "doc_id long, text string")
        began = time.time()
        r = secrets.redact(df).crossJoin(secrets.find_secrets(df, keep=["doc_id"]).drop("doc_id")).first()
        assert r.n_assign == n // 2 and len(r.found) >= n * 0.95 and r.text.count("[SECRET]") >= n * 0.95
        return time.time() - began

    seconds(1000)
    few = max(1.0, seconds(4000))
    assert seconds(32_000) < 12 * few


def test_texts_are_scanned_once_and_not_kept(spark):
    df = spark.createDataFrame([(1, "token=abcdef", 2)], "doc_id long, text string, other int")
    scanned = secrets.scan(df, keep=["other"])
    assert scanned.columns == ["other", "__sec_base", "__sec_cand"]
    plan = secrets.find_secrets(df, keep=["doc_id"])._jdf.queryExecution().executedPlan().toString()
    assert "regexp_extract" not in plan and "text" not in plan
