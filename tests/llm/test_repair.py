import hashlib
import itertools
import random
import re
import time
import zlib

import pytest
from pyspark.sql import functions as F

from cartwise.llm import repair

SF = "/root/testdata/sf0.001"
SCHEMA = "conv_id long, turn long, role string, text string"
SPACE = " \t\n\v\f\r"


# ---- a plain version: every edit sequence's best, by a table of strings ---------------
def faults_of(rows):
    seen, out = set(), []
    for role, text in rows:
        kept = text.strip(SPACE)
        out.append("blank" if not kept else "duplicate" if (role, text) in seen
                   else "truncated" if kept[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def plain_best(rows):
    """(cost, audit, repaired rows) by dynamic programming over (roles so far)."""
    faults = faults_of(rows)
    now = {"": (0, "", ())}  # state: "", "s", "u", "a" -> least (cost, audit), rows

    def better(table, state, value):
        if state not in table or value[:2] < table[state][:2]:
            table[state] = value

    def inserted(table):
        for _ in range(2):
            for state, (cost, audit, kept) in list(table.items()):
                role = "assistant" if state == "u" else "user"
                better(table, role[0], (cost + 2, audit + "I", kept + ((role, ""),)))
        return table

    now = inserted(now)
    for (role, text), fault in zip(rows, faults):
        new = {}
        for state, (cost, audit, kept) in now.items():
            better(new, state, (cost + 3, audit + "D", kept))
            if fault in ("blank", "duplicate"):
                continue
            more = fault == "truncated"
            want = "assistant" if state == "u" else "user"
            if role[:1] == want[0]:
                better(new, want[0], (cost + more, audit + "K", kept + ((role, text),)))
            if role[:1] == "s" and state == "":
                better(new, "s", (cost + more, audit + "K", kept + ((role, text),)))
            better(new, want[0], (cost + more + 2, audit + "R", kept + ((want, text),)))
        now = inserted(new)
    return min((v for s, v in now.items() if s in ("", "a")), key=lambda v: v[:2])


def plain(rows):
    """All columns of the query for one conversation's (turn, role, text) in order."""
    faults = faults_of([r[1:] for r in rows])
    pairs = [a[1][:1] + b[1][:1] for a, b in zip(rows, rows[1:])]
    turns = [r[0] for r in rows if r[0] is not None]
    cost, audit, kept = plain_best([r[1:] for r in rows])
    return {"gaps": max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0,
            "blank": faults.count("blank"), "duplicate": faults.count("duplicate"),
            "truncated": faults.count("truncated"),
            "illegal": sum(p not in ("su", "ua", "au") for p in pairs), "cost": cost, "audit": audit,
            "repaired_sha256": hashlib.sha256("\n".join(f"{r}:{t}" for r, t in kept).encode()).hexdigest()}


def plain_damage(rows):
    out = []
    for conv, turn, role, text in rows:
        key = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = (" " if role is None else role), (" " if text is None else text)
        if key == 1:
            text = ""
        if key == 2:
            text = re.sub("[.!?]", "", text)
        if key == 4:
            role = "user"
        out += [(conv, turn, role, text)] * (0 if key == 0 else 2 if key == 3 else 1)
    return out


def by_conversation(rows):
    def order(r):
        size = str(len(r[2])).encode()
        return (r[1] is not None, r[1] or 0, r[2].encode(),
                hashlib.sha256(size + b":" + r[2].encode() + r[3].encode()).digest())

    out = {}
    for r in sorted(rows, key=order):
        out.setdefault(r[0], []).append(r[1:])
    return out


# ---- the lattice -------------------------------------------------------------------
def test_edits_against_enumeration():
    """Every audit of up to six letters, tried on every conversation of three rows."""
    audits = ["".join(a) for n in range(7) for a in itertools.product("DIKR", repeat=n)]
    kinds = [(r, f) for r in "suax" for f in (0, 1, 2)]

    def tried(rows, audit):
        left, roles, cost = list(rows), "", 0
        for letter in audit:
            want = "a" if roles.endswith("u") else "u"
            if letter == "I":
                roles, cost = roles + want, cost + 2
                continue
            if not left:
                return None
            role, fault = left.pop(0)
            if letter == "D":
                cost += 3
                continue
            if fault == 1:
                return None
            cost += fault == 2
            cost += 2 * (letter == "R")
            roles += role if letter == "K" else want
        return cost if not left and re.fullmatch("(s?(ua)+)?", roles) else None

    rng = random.Random(5)
    for rows in rng.sample(list(itertools.product(kinds, repeat=3)), 40) + [(), (kinds[0],), (kinds[4], kinds[7])]:
        found = [(c, a) for a in audits if (c := tried(rows, a)) is not None]
        codes = bytes(repair.row_code(r, f) for r, f in rows)
        assert repair.cheapest_audit(codes) == min(found)


@pytest.mark.parametrize("seed", range(4))
def test_lattice_against_a_table_of_strings(seed):
    rng = random.Random(seed)
    for _ in range(400):
        rows, clean = [], rng.random() < 0.5
        for i in range(rng.randrange(0, 40)):
            role = ("user", "assistant")[i % 2] if clean and rng.random() < 0.9 else rng.choice(
                ["user", "assistant", "system", "tool", "sys", ""])
            text = rng.choice(["", " \t", "Same.", "cut"]) if rng.random() < 0.3 else f"No {i}."
            rows.append((role, text))
        codes = bytearray(repair.row_code(r, {"": 0, "truncated": 2}.get(f, 1))
                          for (r, _), f in zip(rows, faults_of(rows)))
        assert repair.cheapest_audit(codes) == plain_best(rows)[:2]


def test_long_conversation_in_linear_time():
    def seconds(n):
        rng = random.Random(1)
        codes = bytearray(repair.row_code(rng.choice("uasx"), rng.choice((0, 0, 1, 2))) for _ in range(n))
        began = time.time()
        cost, audit = repair.cheapest_audit(codes)
        assert sum(x != "I" for x in audit) == n
        return time.time() - began

    assert seconds(40_000) < 30 * max(0.1, seconds(4000))


# ---- the operator ---------------------------------------------------------------------
def results(frame):
    out = {}
    for r in frame.collect():
        d = r.asDict()
        out[d.pop("conv_id")] = d
    return out


def test_query_against_the_plain_version(spark):
    table = spark.read.parquet(f"{SF}/conversations.parquet")
    rows = [tuple(r) for r in table.select("conv_id", "turn", "role", "text").collect()]
    want = {c: plain([]) for c, *_ in rows}
    want.update({c: plain(r) for c, r in by_conversation(plain_damage(rows)).items()})
    assert results(repair.op12_repair(spark, SF)) == want


def damage_and_repair(df, spark):
    rows = repair.damaged(df)
    return results(repair.repaired_digests(rows, repair.audits(rows, df)))


def messy(n=400):
    rng = random.Random(3)
    rows = []
    for _ in range(n):
        rows.append((rng.choice([None, 1, 2, 3, 4, 5, 6, 7, -9]), rng.choice([None, 0, 1, 2, 3, 5, 8, 13, 40]),
                     rng.choice([None, "user", "assistant", "system", "", "tool", "usér"]),
                     rng.choice([None, "", " \n", "A.", "B!", "é? ", "no stop", " ", "x. "])))
    return rows + rows[:40] + [(90, None, None, None), (91, 0, "user", "w. " * 300_000)]


def test_nulls_ties_repeats_and_clashing_columns(spark):
    rows = messy()
    df = spark.createDataFrame(rows, SCHEMA).repartition(7)
    df = df.withColumns({c: F.lit(1) for c in ("conv", "kind", "audit", "cost", "present", "digest", "_key")})
    want = {c: plain([]) for c, *_ in rows}
    want.update({c: plain(r) for c, r in by_conversation(plain_damage(rows)).items()})
    assert damage_and_repair(df, spark) == want
    assert damage_and_repair(df.limit(0), spark) == {}


def test_small_batches_cut_conversations_anywhere(spark):
    rows = messy(150)
    df = spark.createDataFrame(rows, SCHEMA)
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    want = damage_and_repair(df, spark)
    try:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
        assert damage_and_repair(df, spark) == want
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)


def test_repaired_rows_follow_the_pattern_and_the_digest(spark):
    df = spark.createDataFrame(messy(), SCHEMA).withColumnRenamed("conv_id", "c").withColumnRenamed("text", "t")
    names = {"conv_col": "c", "text_col": "t"}
    found = repair.audits(df, **names)
    out = repair.repaired(df, found, **names)
    assert out.columns == ["c", "position", "role", "t"]
    lines = {}
    for r in sorted(out.collect(), key=lambda r: r.position):
        assert len(lines.setdefault(r.c, [])) == r.position
        lines[r.c].append((r.role, r.t))
    for r in repair.repaired_digests(df, found, **names).collect():
        mine = lines.get(r.c, [])
        assert re.fullmatch("(s?(ua)+)?", "".join(role[:1] for role, _ in mine))
        text = "\n".join(f"{a}:{b}" for a, b in mine)
        assert r.repaired_sha256 == hashlib.sha256(text.encode()).hexdigest()


def test_all_rows_dropped_and_extreme_turns(spark):
    dropped = next(t for t in range(1000) if zlib.crc32(f"5:{t}".encode()) % 20 == 0)
    low, high = -(1 << 63), (1 << 63) - 1
    rows = [(5, dropped, "user", "Hi."), (6, low, "user", "Hi."), (6, high, "assistant", "Yes.")]
    df = spark.createDataFrame(rows, SCHEMA)
    got = damage_and_repair(df, spark)
    assert got[5] == plain([]) and got[5]["audit"] == "" and got[5]["cost"] == 0
    assert got[5]["repaired_sha256"] == hashlib.sha256(b"").hexdigest()
    plainly = results(repair.audits(df))
    assert plainly[6]["gaps"] == high and plainly[6]["audit"] == "KK"


def test_one_shuffle_in_each_pass_and_no_text_in_the_first(spark):
    df = spark.createDataFrame([(1, 0, "user", "A.")], SCHEMA)
    plan = repair.audits(df)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(conv") == 1
    exchange = next(x for x in plan.splitlines() if "Sort [conv" in x)
    assert "text" not in exchange
