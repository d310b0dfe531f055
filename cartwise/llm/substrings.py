"""Substring dedup by words: windows of 20 words that appeared earlier go.

Super-k-mer partitioning: consecutive windows that share a minimiser travel as
one packed string (words joined by one space) to the minimiser's bucket.  A
bucket numbers its words exactly, ranks windows by doubling (pairs, fours, ...)
and sorts them together with their places; all but the earliest place of a
window are marked.  Marks go back to their document, whose words under any
marked window are removed.

"Earlier" means a smaller id, or an earlier word of the same document; windows
are judged on the input.  Words are runs of bytes other than 0x20 and 0x09-0x0D.

Defined results: null or empty text has no words; texts with fewer words than a
window are kept whole; a null id counts as smaller than any; equal repeated rows
are one document (both are treated alike), rows with one id and different texts
are ordered by a hash of the text; an empty table gives no rows; other columns
are kept, and columns added here replace their namesakes.
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

SIZE, GRAM = 20, 4
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_BASE = 0x9E3779B97F4A7C55
_INVERSE = pow(_BASE, -1, 1 << 64)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


def word_hashes(arr: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hashes of the words [begin, end) of a byte array, by prefix sums."""
    sums = np.concatenate((np.zeros(1, dtype=np.uint64),
                           np.cumsum(win._BYTE[arr] * _powers(_BASE, len(arr)))))
    return win.mix64((sums[end] - sums[begin]) * _powers(_INVERSE, len(arr) + 1)[begin])


def split_words(texts: list, separator: np.ndarray = _SPACE
                ) -> tuple[bytes, np.ndarray, np.ndarray, np.ndarray]:
    """Texts with words joined by one space, the words' bounds, and the number of
    the first word of each text (and past the last)."""
    lens = np.array([len(t) for t in texts], dtype=np.int64)
    arr = np.frombuffer(b"".join(texts), dtype=np.uint8)
    space = separator[arr]
    before = np.empty(len(arr), dtype=bool)  # is there no word just before this byte?
    before[1:] = space[:-1]
    edges = np.concatenate(([0], np.cumsum(lens)))
    before[edges[:-1][lens > 0]] = True
    keep = ~(space & before)
    place = np.concatenate(([0], np.cumsum(keep)))
    data = np.where(space[keep], np.uint8(0x20), arr[keep])
    heads = np.flatnonzero(~space & before)
    begin = place[heads]
    after = np.empty(len(arr), dtype=bool)
    after[:-1] = space[1:]
    after[edges[1:][lens > 0] - 1] = True
    end = place[np.flatnonzero(~space & after)] + 1
    return data.tobytes(), begin, end, np.searchsorted(heads, edges)


def word_units(size: int):
    """Units for :class:`windows.Windows`: chunks of whole texts; a text longer
    than a chunk is cut at white space into pieces that overlap by a window."""

    def pieces(text, chunk: int) -> Iterator[tuple[int, bytes]]:
        text, at, origin = bytes(text), 0, 0
        while len(text) - at > chunk:
            stop = at + chunk
            while stop < len(text) and not _SPACE[text[stop]]:
                stop += 1
            words = text[at:stop].split()
            tail = text[stop:].split(None, size - 1)[:size - 1]
            yield origin, b" ".join([*words, *tail])
            at, origin = stop, origin + len(words)
        yield origin, text[at:] if at else text

    def emit(group: list, gram: int) -> win.Units:
        data, begin, end, first = split_words([g[2] for g in group])
        arr = np.frombuffer(data, dtype=np.uint8)
        h = word_hashes(arr, begin, end)
        grams = np.zeros(len(h), dtype=np.uint64)
        if len(h) >= gram:
            total = np.zeros(len(h) - gram + 1, dtype=np.uint64)
            for k in range(gram):
                total = total * np.uint64(0xD6E8FEB86659FD93) + h[k:len(h) - gram + 1 + k]
            grams[:len(total)] = win.mix64(total)
        return win.Units(data, grams, begin, end, first,
                         np.array([g[1] for g in group], dtype=np.int64),
                         np.array([g[0] for g in group], dtype=np.int64))

    def units(texts: list, gram: int, chunk: int) -> Iterator[win.Units]:
        group, room = [], 0
        for row, text in texts:
            if len(text) < 2 * size - 1:
                continue  # too short for a window
            for origin, piece in pieces(text, chunk):
                group.append((row, origin, piece))
                room += len(piece)
                if room >= chunk:
                    yield emit(group, gram)
                    group, room = [], 0
        if group:
            yield emit(group, gram)

    return units


def _pair(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Exact numbers for pairs of numbers."""
    top = int(right.max()) + 1 if len(right) else 1
    return np.unique(left * top + right, return_inverse=True)[1]


def window_numbers(seq: np.ndarray, size: int) -> np.ndarray:
    """A number for each run of ``size`` items of ``seq``, equal for equal runs."""
    have, rank, of_power = 1, seq, {1: seq}
    while have * 2 <= size:
        rank = _pair(rank[:-have], rank[have:])
        have *= 2
        of_power[have] = rank
    rest, at = size - have, have
    for power in sorted(of_power, reverse=True):
        if rest & power and power < have:
            right = of_power[power][at:]
            n = min(len(rank), len(right))
            rank = _pair(rank[:n], right[:n])
            at += power
    return rank


def earlier(size: int):
    """Bucket solver: marks of windows whose words also start earlier."""

    def solve(strings: list[bytes], entries: np.ndarray) -> np.ndarray:
        distinct, lead, _, alone, others = win.unify(strings, entries)
        found = [win.whole(others)]
        cand = win.candidates(lead, alone)
        if len(cand):
            ids: dict[bytes, int] = {}
            seq = np.array([ids.setdefault(w, len(ids)) for c in cand.tolist()
                            for w in distinct[c].split(b" ")], dtype=np.int64)
            n = lead["n"][cand].astype(np.int64)
            first = np.concatenate(([0], np.cumsum(n + size - 1)[:-1]))
            string = np.repeat(np.arange(len(cand)), n)
            offset = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
            number = window_numbers(seq, size)[first[string] + offset]
            of = lead[cand][string]
            order = np.lexsort((of["start"] + offset, of["tag"], of["id"], number))
            hit = np.zeros(len(order), dtype=bool)
            hit[order[1:]] = number[order[1:]] == number[order[:-1]]
            found.append(win.flagged(lead[cand], string, offset, hit))
        return np.concatenate(found)

    return solve


def remover(size: int, own: list[str], text_col: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = win.text_bytes_of(batch)
            marks = batch.column(batch.schema.names.index(win.MARKS))
            kept, n_words, n_removed, spans = [], [], [], []
            for text, mark in zip(texts, marks):
                words = (text or b"").split()
                total, cuts = len(words), []
                if mark.is_valid:
                    fields = mark.values.flatten()
                    begin, end = win.covered(fields[0].to_numpy(zero_copy_only=False),
                                             fields[1].to_numpy(zero_copy_only=False), size, total)
                    cuts = list(zip(begin.tolist(), end.tolist()))
                    rest, at = [], 0
                    for a, b in cuts:
                        rest += words[at:a]
                        at = b
                    words = rest + words[at:]
                kept.append(b" ".join(words).decode())
                n_words.append(total)
                n_removed.append(total - len(words))
                spans.append([{"start": a, "end": b} for a, b in cuts])
            yield pa.RecordBatch.from_arrays(
                [*win.with_text(batch, own, text_col, texts), pa.array(n_words, pa.int64()),
                 pa.array(n_removed, pa.int64()), pa.array(kept, pa.string()),
                 pa.array(spans, _SPANS)],
                names=[*own, "n_words", "n_removed", "kept", "spans"])

    return run


_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
SPANS = "array<struct<start:bigint,end:bigint>>"


def dedup_words(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                size: int = SIZE, gram: int = GRAM) -> DataFrame:
    """``docs`` with n_words, n_removed, kept (words joined by one space) and
    spans (removed words, merged)."""
    added = ["n_words", "n_removed", "kept", "spans"]
    own = [c for c in docs.columns if c not in added]
    width = size - gram + 1
    # a packed string holds (width + 1) / 2 windows on average and size - 1 words more
    kind = win.Windows(size, gram, word_units(size), 1 + 2 * (size - 1) / (width + 1))
    keyed = win.keyed(docs.select(*own), id_col, text_col)
    joined = win.with_marks(keyed, win.marks(keyed, kind, earlier(size)), text_col)
    schema = T.StructType([*docs.select(*own).schema.fields,
                           *T._parse_datatype_string("n_words long, n_removed long, kept string, "
                                                     f"spans {SPANS}").fields])
    return joined.mapInArrow(remover(size, own, text_col), schema)


def op6_substrings(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return dedup_words(docs).select("doc_id", "n_words", "n_removed",
                                    F.sha2("kept", 256).alias("kept_sha256"))


OP6_SQL = r"""
WITH d AS (
  SELECT doc_id, COALESCE(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS ws FROM documents),
p AS (SELECT doc_id, ws, unnest(range(1, len(ws) - 18)) AS i FROM d),
k AS (SELECT doc_id, i, array_to_string(ws[i:i + 19], ' ') AS win FROM p),
r AS (SELECT doc_id, i, row_number() OVER (PARTITION BY win ORDER BY doc_id, i) AS n FROM k),
c AS (SELECT DISTINCT doc_id, unnest(range(i, i + 20)) AS j FROM r WHERE n > 1),
g AS (SELECT doc_id, list(j) AS js FROM c GROUP BY doc_id),
f AS (SELECT d.doc_id, len(ws) AS n, CASE WHEN js IS NULL THEN ws ELSE
        list_transform(list_filter(range(1, len(ws) + 1), lambda x: NOT list_contains(js, x)),
                       lambda x: ws[x]) END AS kept
      FROM d LEFT JOIN g ON d.doc_id = g.doc_id)
SELECT doc_id, CAST(n AS BIGINT) AS n_words, CAST(n - len(kept) AS BIGINT) AS n_removed,
       sha256(array_to_string(kept, ' ')) AS kept_sha256
FROM f
"""
