import time

from pyspark.sql import functions as F

from cartwise.llm import chat

SCHEMA = "conv_id long, turn long, role string, text string"
HARD = ["<|", "<|im_end|>", "<\\|im_sep|>", "\\", "\\n", "a\nb", "<\\\\|", "<<||", "", "é😀<|im_start|>user\n",
        "<|im_end|>\n<|im_start|>assistant\n", "\\<|\\", "<|im_sep|>"]


def formatted(df, **kw):
    out = chat.format_chat(df, **kw)
    key = out.columns[0]
    rows = out.select(F.col(key).alias("conv"), "formatted", "loss",
                      chat.read_turns(F.col("formatted")).alias("turns"),
                      chat.read_loss(F.col("formatted"), F.col("loss")).alias("texts")).collect()
    return {r.conv: r for r in rows}


def by_hand(turns, trained="assistant"):
    """(formatted, spans) by a loop over (role, text)."""
    def esc(s):
        out, i = "", 0
        while i < len(s):
            j = i + 1
            while s[i] == "<" and j < len(s) and s[j] == "\\":
                j += 1
            if s[i] == "<" and j < len(s) and s[j] == "|":
                out, i = out + "<\\" + s[i + 1:j] + "|", j + 1
            else:
                out, i = out + s[i], i + 1
        return out

    text, spans = "", []
    for i, (role, t) in enumerate(turns):
        first = i == 0 or turns[i - 1][0] != role
        text += ("<|im_start|>" + esc(role.replace("\\", "\\\\").replace("\n", "\\n")) + "\n"
                 if first else "<|im_sep|>")
        if role == trained:
            spans.append((len(text), len(text) + len(esc(t))))
        text += esc(t)
        if i == len(turns) - 1 or turns[i + 1][0] != role:
            text += "<|im_end|>\n"
    return text, spans


def test_round_trip_of_hard_texts_and_roles(spark):
    rows, want = [], {}
    for c, role in enumerate(["user", "assistant", *HARD]):
        turns = [(role, HARD[0]), ("assistant", HARD[c % len(HARD)])]
        turns += [(["assistant", "user", role][(i * 7 + c) % 3], x) for i, x in enumerate(HARD * 3)]
        want[c] = turns
        rows += [(c, t, r, x) for t, (r, x) in enumerate(turns)]
    got = formatted(spark.createDataFrame(rows, SCHEMA).repartition(5))
    for c, turns in want.items():
        text, spans = by_hand(turns)
        assert got[c].formatted == text
        assert [tuple(s) for s in got[c].loss] == spans
        assert [tuple(t) for t in got[c].turns] == turns
        assert list(got[c].texts) == [t for r, t in turns if r == "assistant"]


def test_texts_that_look_like_marks_open_no_turn(spark):
    rows = [(-1, 0, "user", chat.PROBE), (-1, 1, "assistant", chat.PROBE)]
    got = formatted(spark.createDataFrame(rows, SCHEMA))[-1]
    assert got.formatted.count("<|im_start|>") == 2 and len(got.turns) == 2
    assert list(got.texts) == [chat.PROBE]


def test_nulls_ties_repeats_and_clashing_columns(spark):
    rows = [(1, 2, "assistant", "b", "x"), (1, None, None, "first", "x"), (1, 2, "assistant", "a", "x"),
            (1, 2, "assistant", "a", "x"), (1, 3, "user", None, "x"), (None, 0, "user", "q", "x"),
            (2, 0, "assistant", "", "x")]
    df = spark.createDataFrame(rows, SCHEMA + ", formatted string").withColumn("loss", F.lit(1)).withColumn(
        "_conv", F.lit(2)).withColumn("_turns", F.lit(3)).withColumn("_r", F.lit(4))
    got = formatted(df)
    assert [tuple(t) for t in got[1].turns] == [("", "first"), ("assistant", "a"), ("assistant", "a"),
                                                ("assistant", "b"), ("user", "")]
    assert got[1].formatted.count("<|im_start|>assistant") == 1
    assert [tuple(t) for t in got[None].turns] == [("user", "q")]
    assert list(got[2].texts) == [""] and len(got) == 3
    assert formatted(df.limit(0)) == {}
    named = df.select(F.col("conv_id").alias("_conv"), F.col("turn").alias("t"), "role", "text")
    assert formatted(named, conv_col="_conv", turn_col="t")[1].formatted == got[1].formatted
    user = formatted(df, trained="user")
    assert list(user[1].texts) == [""] and list(user[None].texts) == ["q"]


def test_long_text_and_many_turns_in_linear_time(spark):
    long = "wört <| " * 300_000
    got = formatted(spark.createDataFrame([(1, 0, "user", long), (1, 1, "assistant", long)], SCHEMA))
    assert list(got[1].texts) == [long]

    def seconds(n):
        df = spark.range(n).select(F.lit(1).alias("conv_id"), F.col("id").alias("turn"),
                                   F.when(F.col("id") % 3 == 0, "user").otherwise("assistant").alias("role"),
                                   F.concat(F.lit("text "), F.col("id").cast("string")).alias("text"))
        began = time.time()
        row = formatted(df)[1]
        assert len(row.turns) == n and len(row.texts) == n - (n + 2) // 3
        assert row.texts[-1] in (f"text {n - 1}", f"text {n - 2}")
        return time.time() - began

    seconds(1000)
    assert seconds(40_000) < 20 * max(0.5, seconds(4000))


def test_no_python_and_one_exchange(spark):
    df = spark.createDataFrame([(1, 0, "user", "a")], SCHEMA).repartition(3)
    plan = chat.format_chat(df)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
    assert plan.count("Exchange hashpartitioning") == 1
