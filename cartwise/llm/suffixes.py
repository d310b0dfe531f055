"""Suffix-array dedup by bytes: every 200-byte string that occurs twice goes.

Windows are dealt to shards by their minimiser (see ``windows``), so a string
and its repetitions meet in one shard.  Of a shard's packed strings, equal ones
are merged first; those that share a minimiser with a different string are cut
into parts of bounded size, and each part gets

* a suffix array by Larsson-Sadakane refinement: suffixes are ranked by their
  first 8 bytes, then groups of equal rank are refined by the rank 8, 16, 32, ...
  bytes on, leaving settled groups alone;
* common prefixes by Kasai's rule, in lanes of 64 places that advance together: a
  suffix shares at least one byte less with its neighbour than the suffix before
  it in the text did.

Neighbours that share 200 bytes hold the same window.  Equal windows have one
minimiser, so parts end between minimisers; where the strings of one minimiser
need several parts, these are merged by binary search of one part's distinct
windows among the sorted windows of the other.  A string is removed at every place it starts, the same document
and overlapping places included; strings are judged on the input.

Defined results: null text is empty; texts shorter than a window are kept whole;
equal repeated rows (same id and text) are one document, so they are no second
place; rows that share an id but not the text are different documents, and so
are rows without an id; an empty table gives no rows; other columns are kept,
and columns added here replace their namesakes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartwise.llm import windows as win
from cartwise.llm.common import table

SIZE, GRAM = 200, 32
LANE = 64              # places that one lane of Kasai's rule walks
PART_BYTES = 512 << 10   # bytes under one suffix array, small enough for a core's cache


# ---- units ----------------------------------------------------------------
def byte_units(size: int):
    def emit(group: list, gram: int) -> win.Units:
        data = b"".join([g[2] for g in group])
        arr = np.frombuffer(data, dtype=np.uint8)
        h, span = win._BYTE[arr], 1
        mult = 0x9E3779B97F4A7C15
        while span * 2 <= gram and len(h) > span:
            h = h[:-span] * np.uint64(mult) + h[span:]
            mult = (mult * 0xD1342543DE82EF95 + 2) % (1 << 64) | 1
            span *= 2
        grams = np.zeros(len(arr), dtype=np.uint64)
        if span == gram:
            grams[:len(h)] = win.mix64(h)
        first = np.concatenate(([0], np.cumsum([len(g[2]) for g in group])))
        return win.Units(data, grams, None, None, first,
                         np.array([g[1] for g in group], dtype=np.int64),
                         np.array([g[0] for g in group], dtype=np.int64))

    def units(texts: list, gram: int, chunk: int) -> Iterator[win.Units]:
        group, room = [], 0
        for row, text in texts:
            for at in range(0, len(text) - size + 1, chunk):
                piece = text[at:at + chunk + size - 1]
                group.append((row, at, piece))
                room += len(piece)
                if room >= chunk:
                    yield emit(group, gram)
                    group, room = [], 0
        if group:
            yield emit(group, gram)

    return units


# ---- suffix array and common prefixes --------------------------------------
def words8(arr: np.ndarray) -> np.ndarray:
    """The 8 bytes from each place on as one big-endian number, zero past the end."""
    padded = np.concatenate((arr, np.zeros(8, dtype=np.uint8))).astype(np.uint64)
    out = np.zeros(len(arr), dtype=np.uint64)
    for j in range(8):
        out |= padded[j:j + len(arr)] << np.uint64(56 - 8 * j)
    return out


def suffix_array(arr: np.ndarray) -> np.ndarray:
    """Sorted suffix starts by Larsson-Sadakane refinement."""
    n = len(arr)
    key = words8(arr)
    sa = np.argsort(key)
    sorted_key = key[sa]
    new = np.ones(n, dtype=bool)
    new[1:] = sorted_key[1:] != sorted_key[:-1]
    head = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    rank = np.empty(n, dtype=np.int64)
    rank[sa] = head
    h = 8
    while True:
        last = np.append(new[1:], True)
        slots = np.flatnonzero(~(new & last))  # places in groups that are not settled
        if not len(slots):
            return sa
        members = sa[slots]
        ahead = members + h
        inside = ahead < n
        # past the end: the shorter suffix is the smaller
        then = np.where(inside, rank[np.minimum(ahead, n - 1)] + 1, n - ahead)
        both = rank[members] * (n + h + 2) + then + h + 1
        order = np.argsort(both)
        members, both = members[order], both[order]
        sa[slots] = members
        fresh = np.ones(len(slots), dtype=bool)
        fresh[1:] = both[1:] != both[:-1]
        new[slots] = fresh
        rank[members] = np.maximum.accumulate(np.where(fresh, slots, 0))
        h *= 2


def common_prefixes(arr: np.ndarray, sa: np.ndarray, cap: int) -> np.ndarray:
    """Bytes (up to ``cap``) that each suffix shares with its predecessor in
    ``sa``; all lanes of LANE places advance together."""
    n = len(arr)
    key = words8(arr)
    before = np.empty(n, dtype=np.int64)
    before[sa[1:]] = sa[:-1]
    before[sa[0]] = -1
    shared = np.zeros(n, dtype=np.int64)
    first = np.arange(0, n, LANE)
    ends = np.append(first[1:], n)
    lane = np.arange(len(first))
    carry = np.zeros(len(first), dtype=np.int64)
    for step in range(int((ends - first).max())):
        lane = lane[first[lane] + step < ends[lane]]
        at = first[lane] + step
        prev = before[at]
        have = np.maximum(carry[lane] - 1, 0)
        room = np.minimum(cap, n - np.maximum(at, prev))
        live = np.flatnonzero((prev >= 0) & (have < room))
        have[prev < 0] = 0
        while len(live):
            a, b, l = at[live], prev[live], have[live]
            differ = key[a + l] ^ key[b + l]
            equal = np.full(len(live), 8, dtype=np.int64)
            some = differ != 0
            # leading equal bytes: whole bytes above the highest differing bit
            bits = np.frexp(differ[some].astype(np.float64))[1]
            low = np.uint64(1) << np.minimum(bits - 1, 63).astype(np.uint64)
            bits = np.where(differ[some] < low, bits - 1, bits)  # rounding up to a power
            equal[some] = (64 - bits) // 8
            l = np.minimum(l + equal, room[live])
            have[live] = l
            live = live[(equal == 8) & (l < room[live])]
        have = np.minimum(have, np.maximum(room, 0))
        shared[at] = have
        carry[lane] = have
    return shared[sa]


class Part:
    """Suffix array over some strings, and its distinct windows in order."""

    def __init__(self, strings: list[bytes], counts: np.ndarray, size: int):
        self.arr = np.frombuffer(b"".join(strings), dtype=np.uint8)
        lens = np.array([len(s) for s in strings], dtype=np.int64)
        first = np.concatenate(([0], np.cumsum(lens)[:-1]))
        sa = suffix_array(self.arr)
        shared = common_prefixes(self.arr, sa, size)
        # windows begin at the first counts[i] places of string i
        valid = np.zeros(len(self.arr), dtype=bool)
        self.place = np.repeat(first - (np.cumsum(counts) - counts), counts) + np.arange(counts.sum())
        valid[self.place] = True
        group = np.cumsum(shared < size)
        ok = valid[sa]
        self.order, group = sa[ok], group[ok]
        new = np.ones(len(group), dtype=bool)
        new[1:] = group[1:] != group[:-1]
        self.head = np.flatnonzero(new)
        self.sizes = np.diff(np.append(self.head, len(group)))
        self.hit = self.sizes > 1      # per distinct window
        self.key = words8(self.arr)

    @property
    def windows(self) -> np.ndarray:
        return self.order[self.head]

    def repeated(self) -> np.ndarray:
        """For each window, in string order: is it repeated?"""
        flag = np.zeros(len(self.arr), dtype=bool)
        flag[self.order] = np.repeat(self.hit, self.sizes)
        return flag[self.place]


def _compare(x: Part, a: np.ndarray, y: Part, b: np.ndarray, size: int) -> np.ndarray:
    """-1, 0 or 1: the windows at ``a`` of x against those at ``b`` of y."""
    out = np.zeros(len(a), dtype=np.int8)
    live = np.arange(len(a))
    for at in [*range(0, size - 7, 8), *([size - 8] if size % 8 else [])]:
        p, q = x.key[a[live] + at], y.key[b[live] + at]
        out[live] = np.where(p > q, 1, np.where(p < q, -1, 0))
        live = live[p == q]
        if not len(live):
            break
    return out


def merge(x: Part, y: Part, size: int) -> None:
    """Find x's distinct windows among y's by binary search; mark both sides."""
    mine, theirs = x.windows, y.windows
    low = np.zeros(len(mine), dtype=np.int64)
    high = np.full(len(mine), len(theirs), dtype=np.int64)
    live = np.arange(len(mine))
    while len(live):
        live = live[low[live] < high[live]]
        if not len(live):
            break
        mid = (low[live] + high[live]) // 2
        side = _compare(x, mine[live], y, theirs[mid], size)
        same = live[side == 0]
        x.hit[same] = True
        y.hit[mid[side == 0]] = True
        low[live[side > 0]] = mid[side > 0] + 1
        high[live[side < 0]] = mid[side < 0]
        live = live[side != 0]


def _cut(tags: np.ndarray, lens: np.ndarray, part_bytes: int) -> tuple[np.ndarray, np.ndarray]:
    """Part of each string (sorted by minimiser), and which parts belong together.

    Equal windows have one minimiser, so parts end between minimisers and need no
    merging; only the strings of a minimiser that alone exceeds a part are cut
    further, into a family of parts (a number above 0) that are merged.
    """
    new = np.ones(len(tags), dtype=bool)
    new[1:] = tags[1:] != tags[:-1]
    group = np.cumsum(new) - 1
    total = np.bincount(group, weights=lens).astype(np.int64)
    start = np.cumsum(total) - total
    large = total > part_bytes
    inside = np.cumsum(lens) - lens - start[group]
    key = np.stack([start[group] // part_bytes, np.where(large[group], group + 1, 0),
                    np.where(large[group], inside // part_bytes, 0)], axis=1)
    cuts = np.unique(key, axis=0, return_inverse=True)[1].reshape(-1)
    return cuts, key[:, 1]


def anywhere(size: int, part_bytes: int = PART_BYTES):
    """Shard solver: marks of windows that start at two places or more."""

    def solve(strings: list[bytes], entries: np.ndarray) -> np.ndarray:
        distinct, lead, many, alone, others = win.unify(strings, entries)
        found = [win.whole(others), win.whole(lead[many])]
        cand = win.candidates(lead, alone)
        if not len(cand):
            return np.concatenate(found)
        cand = cand[np.argsort(lead["min"][cand], kind="stable")]
        cuts, family = _cut(lead["min"][cand], lead["len"][cand].astype(np.int64), part_bytes)
        parts, members, of = [], [], []
        for c in range(int(cuts.max()) + 1):
            own = cand[cuts == c]
            members.append(own)
            of.append(int(family[cuts == c][0]))
            parts.append(Part([distinct[i] for i in own.tolist()],
                              lead["n"][own].astype(np.int64), size))
        for i, x in enumerate(parts):
            for j in range(i + 1, len(parts)):
                if of[i] and of[i] == of[j]:
                    merge(x, parts[j], size)
        for own, part in zip(members, parts):
            n = lead["n"][own].astype(np.int64)
            string = np.repeat(np.arange(len(own)), n)
            offset = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
            hit = part.repeated() & ~many[own][string]  # the others are marked already
            found.append(win.flagged(lead[own], string, offset, hit))
        return np.concatenate(found)

    return solve


# ---- documents --------------------------------------------------------------
_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
SPANS = "array<struct<start:bigint,end:bigint>>"


def cutter(size: int, own: list[str], text_col: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = win.text_bytes_of(batch)
            marks = batch.column(batch.schema.names.index(win.MARKS))
            kept, n_bytes, n_removed, spans = [], [], [], []
            for text, mark in zip(texts, marks):
                body = text or b""
                total, cuts = len(body), []
                if mark.is_valid:
                    fields = mark.values.flatten()
                    begin, end = win.covered(fields[0].to_numpy(zero_copy_only=False),
                                             fields[1].to_numpy(zero_copy_only=False), size, total)
                    cuts = list(zip(begin.tolist(), end.tolist()))
                    edges = [0, *[x for c in cuts for x in c], total]
                    body = b"".join([body[a:b] for a, b in zip(edges[::2], edges[1::2])])
                kept.append(body)
                n_bytes.append(total)
                n_removed.append(total - len(body))
                spans.append([{"start": a, "end": b} for a, b in cuts])
            yield pa.RecordBatch.from_arrays(
                [*win.with_text(batch, own, text_col, texts), pa.array(n_bytes, pa.int64()),
                 pa.array(n_removed, pa.int64()), pa.array(spans, _SPANS),
                 pa.array(kept, pa.binary())],
                names=[*own, "n_bytes", "n_removed", "spans", "kept"])

    return run


def dedup_bytes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                size: int = SIZE, gram: int = GRAM) -> DataFrame:
    """``docs`` with n_bytes, n_removed, spans (removed byte ranges, merged) and
    kept (the remaining bytes)."""
    added = ["n_bytes", "n_removed", "spans", "kept"]
    own = [c for c in docs.columns if c not in added]
    width = size - gram + 1
    kind = win.Windows(size, gram, byte_units(size), 1 + 2 * (size - 1) / (width + 1))
    keyed = win.keyed(docs.select(*own), id_col, text_col)
    joined = win.with_marks(keyed, win.marks(keyed, kind, anywhere(size)), text_col)
    schema = T.StructType([*docs.select(*own).schema.fields,
                           *T._parse_datatype_string("n_bytes long, n_removed long, "
                                                     f"spans {SPANS}, kept binary").fields])
    return joined.mapInArrow(cutter(size, own, text_col), schema)


def op5_suffixes(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = dedup_bytes(docs)
    return found.select("doc_id", "n_bytes", "n_removed",
                        F.size("spans").cast("long").alias("n_spans"),
                        F.sha2("kept", 256).alias("kept_sha256"))
