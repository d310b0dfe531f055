"""Repeated windows over whole corpora: what substring and suffix-array dedup share.

A window is ``size`` consecutive units (bytes or words) of one document.  Every
window belongs to its minimiser: the smallest hashed gram of ``gram`` units in
it.  Consecutive windows of one document with the same minimiser value travel
together as one packed string to the bucket of that value, so equal windows
always meet in one bucket, wherever they come from.

The order of grams puts those that are frequent in a bounded sample last.  That
order changes balance only, never results: a window uses a gram of a widespread
passage only if it lies inside the passage, and there all packed strings are
equal.  Equal strings are merged before the shuffle, in each map chunk: one
occurrence (the earliest) travels, the others are marked at once.  So a passage
or a copied document that a third of the corpus holds sends one string per map
chunk to its buckets.

Rows are identified by (id, hash of the text): repeated equal rows are one
document, rows that share an id but not the text are different documents.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartwise.llm.common import parts_for, text_bytes

P = "__win_"
ID, TAG, TEXT, MARKS = P + "id", P + "tag", P + "text", P + "marks"
MIN_ID = -(1 << 63)  # a null id, which counts as the smallest
CHUNK_BYTES = 3 << 20    # text handled at once in a map task
BUCKET_BYTES = 16 << 20  # packed strings per bucket, before compression
MAX_RUN = 1024           # windows in one packed string (periodic texts give long runs)
SPREAD = 64              # keys over which marks made by map tasks are dealt

#: One packed string: length, first occurrence (id, tag, start in units),
#: windows, minimiser tag, and whether it may repeat a window within itself /
#: was seen more than once.
ENTRY = np.dtype([("len", "<i4"), ("id", "<i8"), ("tag", "<i4"), ("start", "<i8"), ("n", "<i4"),
                  ("min", "<u4"), ("self", "u1"), ("many", "u1")])
MARK = np.dtype([("id", "<i8"), ("tag", "<i4"), ("start", "<i8"), ("n", "<i8")])

PACKED = "part int, body binary, meta binary"
MARK_SCHEMA = "id long, tag int, start long, n long"


def mix64(h: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser, so that every bit of a hash depends on all input."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


_BYTE = mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


class Frequent:
    """The sample's frequent grams; a small bit table screens lookups."""

    BITS = 20

    def __init__(self, hashes: np.ndarray):
        self.sorted = np.unique(hashes.astype(np.uint64))
        self.screen = np.zeros(1 << self.BITS, dtype=bool)
        self.screen[(self.sorted >> np.uint64(64 - self.BITS)).astype(np.int64)] = True

    def order(self, grams: np.ndarray) -> np.ndarray:
        """Sort keys: the hash's upper 63 bits, below a bit for frequent grams."""
        keys = grams >> np.uint64(1)
        if len(self.sorted):
            maybe = np.flatnonzero(self.screen[(grams >> np.uint64(64 - self.BITS)).astype(np.int64)])
            at = np.searchsorted(self.sorted, grams[maybe])
            at[at == len(self.sorted)] = 0
            hit = maybe[self.sorted[at] == grams[maybe]]
            keys[hit] |= np.uint64(1 << 63)
        return keys


def sliding_min(keys: np.ndarray, width: int) -> np.ndarray:
    """Smallest key of each run of ``width`` keys, by doubling."""
    span, best = 1, keys
    while span * 2 <= width:
        best = np.minimum(best[:-span], best[span:])
        span *= 2
    if span < width:
        rest = width - span
        best = np.minimum(best[:-rest], best[rest:])
    return best


@dataclass
class Units:
    """A chunk of documents as units: their bytes and where units begin."""

    data: bytes            # slices [begin[a], end[b]) are packed strings
    grams: np.ndarray      # hash of the gram that begins at each unit
    begin: np.ndarray | None   # byte offsets of units; None: a unit is a byte
    end: np.ndarray | None
    first: np.ndarray      # first unit of each document, and past the last one
    origin: np.ndarray     # unit number, in its document, of each first unit
    rows: np.ndarray       # row of each document in the batch


@dataclass(frozen=True)
class Windows:
    """What kind of window: ``units`` cuts a batch of texts into Units."""

    size: int
    gram: int
    units: Callable  # (list of (row, text bytes), gram, chunk) -> Iterator[Units]
    expansion: float     # packed bytes per text byte, for the number of buckets

    @property
    def width(self) -> int:
        return self.size - self.gram + 1


def keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``docs`` with the row key (id, hash of the text); null text is empty."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select("*", F.coalesce(F.col(id_col).cast("long"), F.lit(MIN_ID)).alias(ID),
                       F.hash(text).alias(TAG), text.alias(TEXT))


def _texts(batch: pa.RecordBatch) -> list[tuple[int, bytes]]:
    column = batch.column(batch.schema.names.index(TEXT)).cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset:][:len(column) + 1]
    data = memoryview(column.buffers()[2]) if column.buffers()[2] is not None else memoryview(b"")
    return [(i, data[offsets[i]:offsets[i + 1]]) for i in range(len(column))]


def _runs(units: Units, kind: Windows, frequent: Frequent):
    """Runs of windows with one minimiser value: document, first unit, windows, value."""
    keys = frequent.order(units.grams)
    if len(keys) < kind.width:
        return None
    best = sliding_min(keys, kind.width)
    counts = np.maximum(np.diff(units.first) - kind.size + 1, 0)  # windows of each document
    total = int(counts.sum())
    if not total:
        return None
    doc = np.repeat(np.arange(len(counts)), counts)
    offset = np.concatenate(([0], np.cumsum(counts)[:-1]))
    within = np.arange(total) - offset[doc]
    at = units.first[:-1][doc] + within
    value = best[at]
    new = np.empty(total, dtype=bool)
    new[0] = True
    np.not_equal(value[1:], value[:-1], out=new[1:])
    new |= within % MAX_RUN == 0
    heads = np.flatnonzero(new)
    n = np.diff(np.append(heads, total))
    return doc[heads], at[heads], n, value[heads], within[heads]


def _self_repeat(body: bytes, n: int, probe: bytes, probe_at: int, limit: int) -> bool:
    """Whether the string may hold one window twice.  Equal windows of one run
    overlap in the units all its windows share, so the beginning of that shared
    part (``probe``) would appear once more."""
    return n > limit or (n > 1 and body.find(probe, probe_at + 1) >= 0)


def _packer(kind: Windows, buckets: int, frequent: Frequent, chunk: int):
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdCompressor(level=3)
        serial = 0
        for batch in batches:
            names = batch.schema.names
            ids = batch.column(names.index(ID)).to_numpy(zero_copy_only=False)
            tags = batch.column(names.index(TAG)).to_numpy(zero_copy_only=False)
            for units in kind.units(_texts(batch), kind.gram, chunk):
                runs = _runs(units, kind, frequent)
                if runs is None:
                    continue
                doc, at, n, value, within = runs
                row = units.rows[doc]
                start = units.origin[doc] + within
                last = at + n + kind.size - 2
                begin = at if units.begin is None else units.begin[at]
                end = last + 1 if units.end is None else units.end[last]
                data = units.data
                # beginning of the units that all windows of the run share
                probe_units = min(16, kind.size // 4) if units.begin is None else 4
                limit = kind.size - probe_units + 1
                shared = np.minimum(at + n - 1, last - probe_units + 1)
                p0 = shared if units.begin is None else units.begin[shared]
                p1 = (shared + probe_units if units.end is None
                      else units.end[shared + probe_units - 1])
                entry = np.zeros(len(doc), dtype=ENTRY)
                entry["id"], entry["tag"], entry["start"] = ids[row], tags[row], start
                entry["n"] = n
                spread = mix64(value)
                entry["min"] = (spread >> np.uint64(32)).astype(np.uint32)
                part = (spread % np.uint64(buckets)).astype(np.int64)
                order = np.lexsort((entry["start"], entry["tag"], entry["id"]))
                lead: dict[bytes, int] = {}
                again, repeats, alone = [], [], np.zeros(len(doc), dtype=np.uint8)
                b0, b1, n_ = begin.tolist(), end.tolist(), n.tolist()
                q0, q1 = p0.tolist(), p1.tolist()
                for i in order.tolist():
                    body = data[b0[i]:b1[i]]
                    j = lead.setdefault(body, i)
                    if j != i:
                        again.append(i)
                        repeats.append(j)
                    elif _self_repeat(body, n_[i], data[q0[i]:q1[i]], q0[i] - b0[i], limit):
                        alone[i] = 1
                entry["len"], entry["self"] = end - begin, alone
                if again:
                    extra, of = entry[again], entry[repeats]
                    other = ((extra["id"] != of["id"]) | (extra["tag"] != of["tag"])
                             | (extra["start"] != of["start"]))
                    entry["many"][np.asarray(repeats)[other]] = 1
                    marks = np.zeros(int(other.sum()), dtype=MARK)
                    for f in ("id", "tag", "start", "n"):
                        marks[f] = extra[f][other]
                    serial += 1
                    if len(marks):
                        yield _rows([(buckets + serial % SPREAD, b"", press.compress(marks.tobytes()))])
                travel = np.fromiter(lead.values(), dtype=np.int64, count=len(lead))
                travel = travel[np.argsort(part[travel], kind="stable")]
                cuts = np.flatnonzero(np.diff(part[travel], prepend=-1))
                out, room = [], 0
                for a, b in zip(cuts.tolist(), [*cuts[1:].tolist(), len(travel)]):
                    group = travel[a:b]
                    body = press.compress(b"".join([data[b0[i]:b1[i]] for i in group.tolist()]))
                    out.append((int(part[group[0]]), body, press.compress(entry[group].tobytes())))
                    room += len(body)
                    if room > 4 << 20:
                        yield _rows(out)
                        out, room = [], 0
                if out:
                    yield _rows(out)

    return pack


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    part, body, meta = zip(*rows)
    return pa.RecordBatch.from_arrays([pa.array(part, pa.int32()), pa.array(body, pa.binary()),
                                       pa.array(meta, pa.binary())], names=["part", "body", "meta"])


def _mark_table(marks: np.ndarray) -> pa.Table:
    return pa.table([pa.array(marks["id"]), pa.array(marks["tag"]), pa.array(marks["start"]),
                     pa.array(marks["n"])], names=["id", "tag", "start", "n"])


def _solver(solve: Callable, buckets: int):
    def run(key, table):
        unpress = zstandard.ZstdDecompressor()
        metas = [unpress.decompress(m.as_py()) for m in table.column("meta")]
        if key[0].as_py() >= buckets:  # marks of map tasks pass through
            return _mark_table(np.frombuffer(b"".join(metas), dtype=MARK))
        entries = [np.frombuffer(m, dtype=ENTRY) for m in metas]
        strings: list[bytes] = []
        for body, entry in zip(table.column("body"), entries):
            data = unpress.decompress(body.as_py())
            ends = np.cumsum(entry["len"]).tolist()
            strings += [data[a:b] for a, b in zip([0, *ends[:-1]], ends)]
        return _mark_table(solve(strings, np.concatenate(entries)))

    return run


def unify(strings: list[bytes], entries: np.ndarray):
    """Equal strings of a bucket: the entry of the earliest occurrence of each
    distinct string, whether others exist, and the entries of those others."""
    order = np.lexsort((entries["start"], entries["tag"], entries["id"]))
    lead: dict[bytes, int] = {}
    index = [lead.setdefault(strings[i], i) for i in order.tolist()]
    of = np.empty(len(strings), dtype=np.int64)
    of[order] = index
    firsts = np.fromiter(lead.values(), dtype=np.int64, count=len(lead))
    place = np.empty(len(strings), dtype=np.int64)
    place[firsts] = np.arange(len(firsts))
    many = np.bincount(place[of], weights=entries["many"]) > 0
    alone = np.bincount(place[of], weights=entries["self"]) > 0
    first = entries[of]
    other = ((entries["id"] != first["id"]) | (entries["tag"] != first["tag"])
             | (entries["start"] != first["start"]))
    many[place[of[other]]] = True
    distinct = [strings[i] for i in firsts.tolist()]
    return distinct, entries[firsts], many, alone, entries[other]


def candidates(entries: np.ndarray, alone: np.ndarray) -> np.ndarray:
    """Distinct strings that can share a window: with another of the same
    minimiser, or with themselves."""
    _, place, counts = np.unique(entries["min"], return_inverse=True, return_counts=True)
    return np.flatnonzero((counts[place] > 1) | alone)


def whole(entries: np.ndarray) -> np.ndarray:
    """Marks over all windows of the given entries."""
    marks = np.zeros(len(entries), dtype=MARK)
    for f in ("id", "tag", "start", "n"):
        marks[f] = entries[f]
    return marks


def flagged(entries: np.ndarray, string: np.ndarray, offset: np.ndarray,
            hit: np.ndarray) -> np.ndarray:
    """Marks from single windows: (string, offset) sorted, ``hit`` where repeated;
    neighbouring hits of one string become one mark."""
    s, o = string[hit], offset[hit]
    if not len(s):
        return np.zeros(0, dtype=MARK)
    new = np.ones(len(s), dtype=bool)
    new[1:] = (s[1:] != s[:-1]) | (o[1:] != o[:-1] + 1)
    heads = np.flatnonzero(new)
    marks = np.zeros(len(heads), dtype=MARK)
    of = entries[s[heads]]
    marks["id"], marks["tag"] = of["id"], of["tag"]
    marks["start"] = of["start"] + o[heads]
    marks["n"] = np.diff(np.append(heads, len(s)))
    return marks


# ---- frequent grams of a sample -------------------------------------------
SLOTS = 1 << 60


def frequent_grams(docs: DataFrame, kind: Windows, sample_docs: int, share: float) -> np.ndarray:
    """Gram hashes in at least ``share`` of a bounded sample of documents.

    Balance only: the result of an operator is the same with any list.  At most
    (mean grams per document / share) hashes come back.
    """
    n = docs.count()
    if n == 0:
        return np.zeros(0, dtype=np.uint64)
    # so many slots that the sample stays near sample_docs for any number of documents
    slot = F.pmod(F.xxhash64(F.col(ID), F.col(TAG)), F.lit(SLOTS))
    sample = docs.where(slot < max(1, SLOTS * min(n, sample_docs) // n)).select(TEXT)

    def grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for units in kind.units(_texts(batch), kind.gram, CHUNK_BYTES):
                for a, b in zip(units.first[:-1].tolist(), units.first[1:].tolist()):
                    own = units.grams[a:max(a, b - kind.gram + 1)]
                    yield pa.RecordBatch.from_arrays([pa.array(np.unique(own).view(np.int64))],
                                                     names=["gram"])

    least = max(4, int(share * min(n, sample_docs)))
    found = (sample.mapInArrow(grams, "gram long").groupBy("gram").count()
             .where(F.col("count") >= least).select("gram").toPandas())
    return found["gram"].to_numpy(dtype=np.int64).view(np.uint64)


# ---- the whole search -----------------------------------------------------
def marks(docs: DataFrame, kind: Windows, solve: Callable, sample_docs: int = 1000,
          share: float = 0.01) -> DataFrame:
    """(id, tag, array of (start, n)): the repeated windows of every document
    that has any.  ``docs`` comes from :func:`keyed`."""
    narrow = docs.select(ID, TAG, TEXT)
    n_bytes = text_bytes(narrow, TEXT)
    buckets = parts_for(n_bytes * kind.expansion, BUCKET_BYTES)
    frequent = Frequent(frequent_grams(narrow, kind, sample_docs, share))
    packed = narrow.mapInArrow(_packer(kind, buckets, frequent, CHUNK_BYTES), PACKED)
    found = packed.groupBy("part").applyInArrow(_solver(solve, buckets), MARK_SCHEMA)
    return (found.groupBy(F.col("id").alias(P + "mid"), F.col("tag").alias(P + "mtag"))
            .agg(F.collect_list(F.struct("start", "n")).alias(MARKS)))


def with_marks(docs: DataFrame, found: DataFrame, text_col: str) -> DataFrame:
    """``docs`` (keyed) with each document's marks, null where it has none; texts
    are compressed for the shuffle: instead of ``text_col``, TEXT holds bytes that
    :func:`text_bytes_of` opens, null for a null text."""
    rest = [c for c in docs.columns if c not in (TEXT, text_col)]
    schema = T.StructType([*docs.select(*rest).schema.fields, T.StructField(TEXT, T.BinaryType())])

    def press(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = zstandard.ZstdCompressor(level=3)
        for batch in batches:
            names = batch.schema.names
            texts = [tool.compress(t.as_buffer()) if t.is_valid else None
                     for t in batch.column(names.index(TEXT))]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(names.index(c)) for c in rest], pa.array(texts, pa.binary())],
                names=[*rest, TEXT])

    packed = docs.select(*rest, F.col(text_col).alias(TEXT)).mapInArrow(press, schema)
    return (packed.join(found, (F.col(ID) == F.col(P + "mid")) & (F.col(TAG) == F.col(P + "mtag")),
                        "left").drop(P + "mid", P + "mtag"))


def text_bytes_of(batch: pa.RecordBatch) -> list[bytes | None]:
    """The texts that :func:`with_marks` compressed."""
    tool = zstandard.ZstdDecompressor()
    return [tool.decompress(t.as_py()) if t.is_valid else None
            for t in batch.column(batch.schema.names.index(TEXT))]


def with_text(batch: pa.RecordBatch, own: list[str], text_col: str, bodies: list) -> list[pa.Array]:
    """The columns ``own`` of a batch, the text column from its bytes."""
    names = batch.schema.names
    return [pa.array([None if b is None else b.decode() for b in bodies], pa.string())
            if c == text_col else batch.column(names.index(c)) for c in own]


def covered(starts: np.ndarray, counts: np.ndarray, size: int, total: int):
    """Merged unit spans [begin, end) that windows [start, start + n) cover."""
    order = np.argsort(starts, kind="stable")
    begin = starts[order]
    end = np.minimum(begin + counts[order] + size - 1, total)
    reach = np.maximum.accumulate(end)
    new = np.ones(len(begin), dtype=bool)
    new[1:] = begin[1:] > reach[:-1]
    heads = np.flatnonzero(new)
    return begin[heads], reach[np.append(heads[1:], len(begin)) - 1]
