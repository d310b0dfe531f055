r"""Repair of the turn structure of conversations by a cheapest edit.

Faults.  The rows of a conversation are read by turn.  A row is *blank* if its text
holds no character but ASCII white space, else *duplicate* if role and text were
seen earlier in the conversation, else *truncated* if the last character that is not
white space is none of ``.!?``.

Edits.  Keep (K, 0), rerole to user or assistant (R, 2), delete (D, 3; the only one
for blank and duplicate rows), insert an empty turn of user or assistant (I, 2); a
truncated row that stays costs 1 more.  The roles' initials must end as
``(s?(ua)+)?``.  The lattice has a node for each row number and state of that
pattern (nothing yet, after s, after u, after a); the letters D, I, K, R lead on
uniquely.  Two heaps search it, forward from the start and in reverse from the ends,
until no path through unsettled nodes can be as cheap as the best crossing; by then
every node of every cheapest path is settled by one of them.  The audit is walked
forward over the nodes of cheapest paths, the least letter first, which is the least
of all concatenations (of equally cheap ways to one node none begins another, as
more inserts cost more).

Scale.  Pass one shuffles narrow rows (turn, role, a digest of role and text, two
flags) by conversation, sorted, and streams them: a conversation is a byte a row, the
digests seen, and while searching some 60 bytes a row.  Pass two shuffles the texts,
sorted the same way behind the conversation's audit, and streams the repaired rows
without holding them.  A conversation's audit is one string and its digest one
sequence, so a single conversation is one task's work whatever its size; its texts
are never in memory together, and sorting spills.

Defined results: null roles and texts are one space (so such a text is blank and
such a role is neither s, u nor a); null turns come first; ties of turn go by role,
then by the digest of role and text; repeated rows are rows (the second is a
duplicate); a null conversation is a conversation; ``known`` conversations without
rows have zeros and an empty audit; gaps beyond a long stop at its end; an empty
table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from array import array
from collections.abc import Iterator
from heapq import heappop, heappush

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartwise.llm.common import table

# White space, ends of sentences, costs.
BLANK = " \t\n\v\f\r"
STOPS = ".!?"
REROLE, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1

CLEAN, DOOMED, CUT = 0, 1, 2           # what a row's fault means for its edits
S, U, A, OTHER = 0, 1, 2, 3            # initials
START, AFTER_S, AFTER_U, AFTER_A = 0, 1, 2, 3
_INITIAL = {"s": S, "u": U, "a": A}
_LEGAL = {(S, U), (U, A), (A, U)}
_BEFORE_U = (START, AFTER_S, AFTER_A)
_MOST = (1 << 63) - 1
BATCH = 4096


# ---- the lattice ---------------------------------------------------------------
def row_code(role: str, fault: int) -> int:
    return _INITIAL.get(role[:1], OTHER) * 4 + fault


def edges(codes, i: int, state: int) -> list[tuple[int, int, str]]:
    """(cost, node, letter) of the edits at row ``i`` in ``state``; node = 4 * row + state."""
    want, then = (A, AFTER_A) if state == AFTER_U else (U, AFTER_U)
    out = [(INSERT, 4 * i + then, "I")]
    if i < len(codes):
        out.append((DELETE, 4 * i + 4 + state, "D"))
        initial, fault = codes[i] >> 2, codes[i] & 3
        if fault != DOOMED:
            more = TRUNCATED if fault == CUT else 0
            if initial == S and state == START:
                out.append((more, 4 * i + 4 + AFTER_S, "K"))
            if initial == want:
                out.append((more, 4 * i + 4 + then, "K"))
            else:
                out.append((REROLE + more, 4 * i + 4 + then, "R"))
    return out


def edges_into(codes, i: int, state: int) -> list[tuple[int, int]]:
    """(cost, node) of the nodes from which one edit leads to row ``i``, ``state``."""
    before = _BEFORE_U if state == AFTER_U else (AFTER_U,) if state == AFTER_A else ()
    out = [(INSERT, 4 * i + q) for q in before]
    if i:
        out.append((DELETE, 4 * i - 4 + state))
        initial, fault = codes[i - 1] >> 2, codes[i - 1] & 3
        if fault != DOOMED:
            more = TRUNCATED if fault == CUT else 0
            if state == AFTER_S and initial == S:
                out.append((more, 4 * i - 4 + START))
            cost = more if initial == (A if state == AFTER_A else U) else REROLE + more
            out += [(cost, 4 * i - 4 + q) for q in before]
    return out


def cheapest_audit(codes) -> tuple[int, str]:
    """(cost, least audit) of a conversation whose rows have these codes."""
    n = len(codes)
    size = 4 * n + 4
    far = [array("i", [-1]) * size, array("i", [-1]) * size]  # forward, reverse
    done = [bytearray(size), bytearray(size)]
    heaps: list[list[int]] = [[START], [4 * n + START, 4 * n + AFTER_A]]  # cost * size + node
    for side, heap in enumerate(heaps):
        for node in heap:
            far[side][node] = 0
    best = 0 if far[0][4 * n + START] == 0 else -1
    while heaps[0] and heaps[1]:
        tops = heaps[0][0] // size, heaps[1][0] // size
        if 0 <= best < tops[0] + tops[1]:
            break
        side = 0 if tops[0] <= tops[1] else 1
        cost, node = divmod(heappop(heaps[side]), size)
        if done[side][node]:
            continue
        done[side][node] = 1
        mine, other = far[side], far[1 - side]
        step = edges if side == 0 else edges_into
        for edge in step(codes, node >> 2, node & 3):
            now, to = cost + edge[0], edge[1]
            if mine[to] < 0 or now < mine[to]:
                mine[to] = now
                heappush(heaps[side], now * size + to)
            if other[to] >= 0 and (best < 0 or now + other[to] < best):
                best = now + other[to]
    return best, _least_audit(codes, best, far, done)


def _least_audit(codes, best: int, far, done) -> str:
    forward, reverse = far
    ends = (4 * len(codes) + START, 4 * len(codes) + AFTER_A)
    # forward nodes from which a cheapest path goes on to a crossing (or ends)
    stack, good = [], bytearray(len(forward))
    for node in range(len(forward)):
        if done[0][node] and (node in ends and forward[node] == best or any(
                done[1][to] and forward[node] + cost + reverse[to] == best
                for cost, to, _ in edges(codes, node >> 2, node & 3))):
            good[node] = 1
            stack.append(node)
    while stack:
        node = stack.pop()
        for cost, back in edges_into(codes, node >> 2, node & 3):
            if done[0][back] and not good[back] and forward[back] + cost == forward[node]:
                good[back] = 1
                stack.append(back)
    audit, node, spent = [], START, 0
    while not (spent == best and node in ends):
        letter, cost, node = min(
            (letter, cost, to) for cost, to, letter in edges(codes, node >> 2, node & 3)
            if done[1][to] and spent + cost + reverse[to] == best
            or good[to] and spent + cost == forward[to])
        audit.append(letter)
        spent += cost
    return "".join(audit)


# ---- pass one: faults and audits --------------------------------------------------
class _Conversation:
    """What is gathered of one conversation's rows, in order."""

    def __init__(self) -> None:
        self.codes = bytearray()
        self.seen: set[bytes] = set()
        self.faults = {"blank": 0, "duplicate": 0, "truncated": 0}
        self.illegal = 0
        self.low = self.high = None
        self.turns = 0

    def add(self, turn, role: str, digest: bytes, blank: bool, cut: bool) -> None:
        fault = ("blank" if blank else "duplicate" if digest in self.seen
                 else "truncated" if cut else None)
        self.seen.add(digest)
        if fault:
            self.faults[fault] += 1
        code = row_code(role, CLEAN if not fault else CUT if fault == "truncated" else DOOMED)
        if self.codes and (self.codes[-1] >> 2, code >> 2) not in _LEGAL:
            self.illegal += 1
        self.codes.append(code)
        if turn is not None:
            self.turns += turn != self.high
            self.low = turn if self.low is None else self.low
            self.high = turn

    def result(self) -> dict:
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.turns
        cost, audit = cheapest_audit(self.codes)
        return {"gaps": min(gaps, _MOST), **self.faults, "illegal": self.illegal, "cost": cost,
                "audit": audit}


_COUNTS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]


def _audits(schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, size, conv, now = [], 0, None, None
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if now is None or row[0] != conv:
                    if now is not None:
                        out.append({"conv": conv, **now.result()})
                        size += 64 + len(out[-1]["audit"])
                        if size > 1 << 20:
                            yield pa.RecordBatch.from_pylist(out, schema)
                            out, size = [], 0
                    conv, now = row[0], _Conversation()
                if row[1]:  # else it only says that the conversation is known
                    now.add(*row[2:])
        if now is not None:
            out.append({"conv": conv, **now.result()})
        if out:
            yield pa.RecordBatch.from_pylist(out, schema)

    return run


def _arrow(name: str, kind: T.DataType) -> pa.Field:
    from pyspark.sql.pandas.types import to_arrow_type

    return pa.field(name, to_arrow_type(kind))


def _rows(conversations: DataFrame, conv_col, turn_col, role_col, text_col) -> DataFrame:
    role, text = F.col(role_col).cast("string"), F.col(text_col).cast("string")
    rows = conversations.select(F.col(conv_col).alias("conv"), F.col(turn_col).cast("long").alias("turn"),
                                F.coalesce(role, F.lit(" ")).alias("role"),
                                F.coalesce(text, F.lit(" ")).alias("text"))
    size = F.char_length("role").cast("string")
    return rows.withColumn("digest", F.unhex(F.sha2(F.concat(size, F.lit(":"), "role", "text"), 256)))


def _in_order(rows: DataFrame, kind: str) -> DataFrame:
    return rows.repartition("conv").sortWithinPartitions(
        "conv", kind, F.asc_nulls_first("turn"), "role", "digest")


def audits(conversations: DataFrame, known: DataFrame | None = None, conv_col: str = "conv_id",
           turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """One row per conversation: its id (under ``conv_col``), gaps, blank, duplicate,
    truncated, illegal, cost (longs) and audit.  ``known`` has ids (in ``conv_col``) of
    conversations to report even if they have no rows."""
    trimmed = F.rtrim(F.col("text"), F.lit(BLANK))
    narrow = _rows(conversations, conv_col, turn_col, role_col, text_col).select(
        "conv", F.lit(True).alias("present"), "turn", "role", "digest",
        (trimmed == "").alias("blank"), (~F.right(trimmed, F.lit(1)).isin(*STOPS)).alias("cut"))
    if known is not None:
        none = [F.lit(None).cast(narrow.schema[c].dataType).alias(c) for c in narrow.columns[2:]]
        narrow = narrow.unionByName(known.select(F.col(conv_col).alias("conv")).distinct()
                                    .select("conv", F.lit(False).alias("present"), *none))
    kind = conversations.schema[conv_col].dataType
    fields = [_arrow("conv", kind), *[pa.field(c, pa.int64()) for c in _COUNTS],
              pa.field("audit", pa.string())]
    schema = T.StructType([T.StructField("conv", kind),
                           *[T.StructField(c, T.LongType()) for c in _COUNTS],
                           T.StructField("audit", T.StringType())])
    out = _in_order(narrow, "present").mapInArrow(_audits(pa.schema(fields)), schema)
    return out.withColumnRenamed("conv", conv_col)


# ---- pass two: repaired rows --------------------------------------------------------
def _repaired(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """(conversation, None, header) before the rows of each conversation, then
    (conversation, role, text) for each repaired row.  Input: a conversation's header
    row (kind 0, its audit as text), then its rows (kind 1)."""
    conv, audit, at, turn_of = None, "", 0, "user"

    def inserts():
        nonlocal at, turn_of
        while at < len(audit) and audit[at] == "I":
            yield conv, turn_of, ""
            at, turn_of = at + 1, "assistant" if turn_of == "user" else "user"

    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns)):
            if row[1] == 0:
                yield from inserts()
                conv, audit, at, turn_of = row[0], row[5], 0, "user"
                yield conv, None, row
                continue
            yield from inserts()
            letter, role, at = audit[at], row[3], at + 1
            if letter == "D":
                continue
            if letter == "K" and role[:1] == "s":
                yield conv, role, row[5]
                continue
            yield conv, turn_of if letter == "R" else role, row[5]
            turn_of = "assistant" if turn_of == "user" else "user"
    yield from inserts()


def _repaired_stream(conversations: DataFrame, found: DataFrame, conv_col, turn_col, role_col,
                     text_col) -> DataFrame:
    rows = _rows(conversations, conv_col, turn_col, role_col, text_col).select(
        "conv", F.lit(1).alias("kind"), "turn", "role", "digest", "text",
        *[F.lit(None).cast("long").alias(c) for c in _COUNTS])
    heads = found.select(
        F.col(conv_col).alias("conv"), F.lit(0).alias("kind"), F.lit(None).cast("long").alias("turn"),
        F.lit(None).cast("string").alias("role"), F.lit(None).cast("binary").alias("digest"),
        F.col("audit").alias("text"), *_COUNTS)
    return _in_order(rows.unionByName(heads), "kind")


def repaired(conversations: DataFrame, found: DataFrame, conv_col: str = "conv_id",
             turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """The repaired rows: ``conv_col``, position (from 0), ``role_col``, ``text_col``.
    ``found`` is what :func:`audits` returned for the same rows."""
    kind = conversations.schema[conv_col].dataType
    schema = pa.schema([_arrow("conv", kind), pa.field("position", pa.int64()),
                        pa.field("role", pa.string()), pa.field("text", pa.string())])

    def run(batches):
        out, size, at = [], 0, 0
        for conv, role, text in _repaired(batches):
            if role is None:
                at = 0
                continue
            out.append({"conv": conv, "position": at, "role": role, "text": text})
            at, size = at + 1, size + len(text) + 32
            if len(out) >= BATCH or size > 4 << 20:
                yield pa.RecordBatch.from_pylist(out, schema)
                out, size = [], 0
        if out:
            yield pa.RecordBatch.from_pylist(out, schema)

    rows = _repaired_stream(conversations, found, conv_col, turn_col, role_col, text_col).mapInArrow(
        run, T.StructType([T.StructField("conv", kind), T.StructField("position", T.LongType()),
                           T.StructField("role", T.StringType()), T.StructField("text", T.StringType())]))
    return rows.toDF(conv_col, "position", role_col, text_col)


def repaired_digests(conversations: DataFrame, found: DataFrame, conv_col: str = "conv_id",
                     turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """``found`` with repaired_sha256: the digest of the repaired ``role:text`` lines."""
    kind = conversations.schema[conv_col].dataType
    schema = pa.schema([_arrow("conv", kind), *[pa.field(c, pa.int64()) for c in _COUNTS],
                        pa.field("audit", pa.string()), pa.field("repaired_sha256", pa.string())])

    def run(batches):
        out, head, digest, first, size = [], None, None, True, 0

        def closed():
            return {"conv": head[0], **dict(zip(_COUNTS, head[6:])), "audit": head[5],
                    "repaired_sha256": digest.hexdigest()}

        for conv, role, row in _repaired(batches):
            if role is None:
                if head is not None:
                    out.append(closed())
                    size += 200 + len(head[5])
                    if size > 1 << 20:
                        yield pa.RecordBatch.from_pylist(out, schema)
                        out, size = [], 0
                head, digest, first = row, hashlib.sha256(), True
                continue
            digest.update(("" if first else "\n").encode() + f"{role}:{row}".encode())
            first = False
        if head is not None:
            out.append(closed())
        if out:
            yield pa.RecordBatch.from_pylist(out, schema)

    out = _repaired_stream(conversations, found, conv_col, turn_col, role_col, text_col).mapInArrow(
        run, T.StructType([T.StructField("conv", kind),
                           *[T.StructField(c, T.LongType()) for c in _COUNTS],
                           T.StructField("audit", T.StringType()),
                           T.StructField("repaired_sha256", T.StringType())]))
    return out.withColumnRenamed("conv", conv_col)


# ---- the query -----------------------------------------------------------------------
def damaged(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text with seeded faults: by crc32("conv_id:turn") mod 20,
    0 drops a row, 1 empties its text, 2 takes ``.!?`` from it, 3 repeats it, 4 makes it
    the user's; nulls are one space."""
    def shown(c) -> Column:
        return F.coalesce(F.col(c).cast("string"), F.lit(" "))

    key = (F.crc32(F.concat(shown("conv_id"), F.lit(":"), shown("turn"))) % 20).cast("int")
    text = (F.when(F.col("_key") == 1, F.lit(""))
            .when(F.col("_key") == 2, F.regexp_replace(shown("text"), r"[.!?]", ""))
            .otherwise(shown("text")))
    times = F.when(F.col("_key") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return (conversations.select("conv_id", "turn", "role", "text", key.alias("_key"))
            .where(F.col("_key") != 0)
            .select("conv_id", "turn",
                    F.when(F.col("_key") == 4, F.lit("user")).otherwise(shown("role")).alias("role"),
                    text.alias("text"), F.explode(times).alias("_time"))
            .drop("_time"))


def op12_repair(spark, sf_dir):
    conversations = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    rows = damaged(conversations)
    return repaired_digests(rows, audits(rows, conversations))
