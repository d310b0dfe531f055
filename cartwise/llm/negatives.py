"""Hard negatives: exact thresholded inner products over length buckets.

Components become the whole numbers ``floor(scale * x)``; a row's score for an anchor
is the inner product of these.  An anchor's positives are its best rows of the same
label; the negatives of a positive are the best rows of another label whose score
lies between ``low`` percent of the positive's score and that score.

Index.  Rows are cut into classes of length by quantiles, longest first, and each
class is dealt to buckets of about ``bucket_rows`` rows.  A bucket holds its vectors
and, for every coordinate, its rows in the order of their normalised values (the
coordinate lists).

Search.  Every anchor asks for the best ``k`` rows with a score between a floor and a
top (several such ranges at once, one for each positive).  In a bucket, a floor over
the anchor's length and the bucket's greatest length is the least cosine.  Beyond 1,
the bucket is skipped.  Otherwise the coordinates where the normalised anchor is
largest are its focus: two unit vectors within that angle differ on a coordinate's
own angle by no more, so each focus coordinate has a feasible range, found in its
list by binary search.  The rows of the shortest range that lie in the other ranges
too are the candidates; they are verified by whole-number inner products.  Where the
shortest range holds over half of the bucket, or the floor is not positive, all its
rows are candidates.

Buckets are searched in rounds, the longest few first; after a round the ``k``-th
best so far is the new floor.  Rounds grow fourfold, so the rows found above the
floors stay near ``4 k`` per range and round, however many buckets there are.  The
anchors are a written table that each task reads in blocks; no row carries a bucket
or a block to another task.  A task holds one bucket and a block of anchors.

Scores are exact while they fit in a long; beyond, they stop at its ends.

Defined results: rows with a null id, label or vector, or a null or non-finite
component (or one that ``scale`` carries beyond a double) take no part; zero vectors
do, with score 0; equal repeated rows are one row; rows of one id with other labels
or vectors are rows of their own, but never positives or negatives of an anchor of
that id; vectors of another length than the anchor's are not compared; ties go to
the smaller id; fewer rows than asked for are all returned; a positive of negative
score has no negatives; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cartwise.llm.common import parts_for, table, written
from cartwise.llm.warc import _open_fs
from cartwise.session import scratch_path

BUCKET_ROWS = 4096
CLASSES = 64            # of length, at most
FOCUS = 4               # coordinates whose ranges are intersected
FIRST_ROUND, GROWTH = 4, 4
ANCHOR_ROWS = 256       # anchors searched together
LEAST, MOST = -(1 << 63), (1 << 63) - 1
INDEX = "rank int, dim int, ids binary, labels binary, vectors binary, kind string, lists binary"
KEYS = ["anchor_id", "anchor_key", "slot"]
FOUND = "anchor_id long, anchor_key long, slot int, vec_id long, score long"


# ---- rows that take part ----------------------------------------------------------
def _whole(batch: pa.RecordBatch, scale: float) -> pa.RecordBatch:
    """The rows that take part, with whole-number vectors and their lengths."""
    lists = batch.column("vector")
    size = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = lists.flatten().to_numpy(zero_copy_only=False)  # null components are NaN
    row = np.repeat(np.arange(len(size)), size)
    with np.errstate(all="ignore"):
        whole = np.floor(flat * scale)
    ok = pc.is_valid(lists).to_numpy(zero_copy_only=False)
    ok &= np.bincount(row[~np.isfinite(whole)], minlength=len(size)) == 0
    keep = ok[row]
    batch, whole, row = batch.filter(pa.array(ok)), whole[keep], (np.cumsum(ok) - 1)[row[keep]]
    size = size[ok]
    first = np.concatenate(([0], np.cumsum(size)))
    some = size > 0
    peak = np.ones(len(size))  # squares of large numbers would overflow
    if some.any():
        peak[some] = np.maximum.reduceat(np.abs(whole), first[:-1][some])
    peak[peak == 0] = 1
    part = whole / peak[row]
    length = np.sqrt(np.bincount(row, part * part, minlength=len(size))) * peak
    vector = pa.ListArray.from_arrays(pa.array(first, pa.int32()), pa.array(whole))
    return pa.RecordBatch.from_arrays(
        [batch.column("vec_id"), batch.column("label"), batch.column("anchor"), vector, pa.array(length)],
        names=["vec_id", "label", "anchor", "vector", "length"])


def usable(df: DataFrame, is_anchor: Column, scale: float, id_col: str, label_col: str,
           vec_col: str) -> DataFrame:
    """(vec_id, label, anchor, vector, length) of the rows that take part, as a written
    table: vectors are whole numbers, as doubles."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield _whole(batch, scale)

    rows = df.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull()).select(
        F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).cast("long").alias("label"),
        F.coalesce(is_anchor, F.lit(False)).alias("anchor"),
        F.col(vec_col).cast("array<double>").alias("vector"))
    return written(rows.mapInArrow(run, "vec_id long, label long, anchor boolean, vector array<double>, "
                                        "length double"), "negatives-rows")


# ---- index --------------------------------------------------------------------------
def _packed(v: np.ndarray) -> tuple[str, bytes]:
    """The smallest type that holds the whole numbers."""
    most = np.abs(v).max(initial=0)
    kind = "int16" if most < 1 << 15 else "int32" if most < 1 << 31 else "float64"
    return kind, v.astype(kind).tobytes()


def _unit(v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Normalised rows (zero rows stay zero) and their lengths."""
    peak = np.abs(v).max(axis=1, initial=0)  # squares of large numbers would overflow
    safe = np.where(peak > 0, peak, 1.0)
    part = v / safe[:, None]
    length = np.sqrt((part * part).sum(axis=1))
    return part / np.where(length > 0, length, 1.0)[:, None], length * safe


def _matrix(column) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _bucket(key, rows):
    ids = rows.column("vec_id").to_numpy()
    labels = rows.column("label").to_numpy()
    v = _matrix(rows.column("vector")) if key[0].as_py() else np.zeros((len(ids), 0))
    order = np.argsort(ids, kind="stable")
    if (np.diff(ids[order]) == 0).any():
        order = np.lexsort((*v.T[::-1], labels, ids))
    ids, labels, v = ids[order], labels[order], v[order]
    new = np.ones(len(ids), dtype=bool)  # equal rows are one
    new[1:] = (ids[1:] != ids[:-1]) | (labels[1:] != labels[:-1]) | (v[1:] != v[:-1]).any(axis=1)
    ids, labels, v = ids[new], labels[new], v[new]
    kind, packed = _packed(v)
    lists = np.argsort(_unit(v)[0], axis=0, kind="stable").astype(np.int32)
    return pa.table({
        "rank": pa.array([key[1].as_py()], pa.int32()), "dim": pa.array([v.shape[1]], pa.int32()),
        "ids": [ids.astype(np.int64).tobytes()], "labels": [labels.astype(np.int64).tobytes()],
        "vectors": [packed], "kind": [kind], "lists": [lists.T.tobytes()]})


def build_index(rows: DataFrame, bucket_rows: int = BUCKET_ROWS) -> tuple[DataFrame, int]:
    """Buckets as a written table, and how many ranks (longest first) they have.  The
    driver reads the quantiles and the sizes of at most ``CLASSES`` classes."""
    n = rows.count()
    classes = min(CLASSES, parts_for(n, bucket_rows))
    cuts = []
    if classes > 1:
        shares = [1 - (i + 1) / classes for i in range(classes - 1)]
        cuts = rows.agg(F.percentile_approx("length", shares, 10_000)).first()[0]
    klass = F.lit(0)
    for cut in cuts:
        klass = klass + F.when(F.col("length") < F.lit(cut), 1).otherwise(0)
    rows = rows.withColumn("_class", klass)
    sizes = {r["_class"]: r["count"] for r in rows.groupBy("_class").count().collect()}
    parts = [parts_for(sizes.get(c, 0), bucket_rows) for c in range(classes)]
    firsts = [sum(parts[:c]) for c in range(classes)]
    deal = F.pmod(F.xxhash64("vec_id"), F.get(F.array(*map(F.lit, parts)), F.col("_class")))
    rank = F.get(F.array(*map(F.lit, firsts)), F.col("_class")) + deal
    dealt = rows.select("vec_id", "label", "vector", F.size("vector").alias("dim"),
                        rank.cast("int").alias("rank"))
    return written(dealt.groupBy("dim", "rank").applyInArrow(_bucket, INDEX), "negatives-index"), sum(parts)


# ---- one bucket -----------------------------------------------------------------------
def products(q: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Exact inner products of whole-number rows as longs, stopping at their ends."""
    a, b = np.abs(q).max(initial=0), np.abs(v).max(initial=0)
    bound = float(a) * float(b) * max(1, q.shape[1])
    if bound < 1 << 53:
        return (q @ v.T).astype(np.int64)
    if bound < 1 << 62 and max(a, b) < 1 << 62:
        return q.astype(np.int64) @ v.astype(np.int64).T
    exact = np.array([[int(x) for x in r] for r in q], dtype=object).reshape(q.shape) \
        @ np.array([[int(x) for x in r] for r in v], dtype=object).reshape(v.shape).T
    return np.clip(exact, LEAST, MOST).astype(np.int64)


class Bucket:
    def __init__(self, row: dict):
        self.ids = np.frombuffer(row["ids"], dtype=np.int64)
        self.labels = np.frombuffer(row["labels"], dtype=np.int64)
        self.dim, m = row["dim"], len(self.ids)
        self.vectors = np.frombuffer(row["vectors"], dtype=row["kind"]).astype(np.float64).reshape(m, self.dim)
        self.unit, lengths = _unit(self.vectors)
        self.longest = lengths.max(initial=0)
        self.lists = np.frombuffer(row["lists"], dtype=np.int32).reshape(self.dim, m)
        self.sorted = np.take_along_axis(self.unit.T, self.lists, axis=1)  # a row per coordinate

    def candidates(self, q: np.ndarray, floors: np.ndarray) -> tuple[np.ndarray, dict[int, np.ndarray]]:
        """Anchors for which every row is a candidate, and the candidates of others
        (anchors in neither have none)."""
        unit, length = _unit(q)
        reach = length * self.longest
        cosine = np.where(reach > 0, floors / np.where(reach > 0, reach, 1.0), np.inf)
        cosine = np.where(floors > 0, cosine * (1 - 1e-9), -1.0)
        every = np.flatnonzero(floors <= 0)
        some = np.flatnonzero((floors > 0) & (cosine <= 1.0))
        focus = min(FOCUS, self.dim)
        if not len(some) or not focus:
            return every, {}
        u = unit[some]
        coords = np.argpartition(-np.abs(u), focus - 1, axis=1)[:, :focus]
        own = np.arccos(np.clip(np.take_along_axis(u, coords, axis=1), -1, 1))
        angle = np.arccos(cosine[some])[:, None]
        low = np.where(own + angle < np.pi, np.cos(np.minimum(own + angle, np.pi)), -1.0) - 1e-9
        high = np.where(own > angle, np.cos(np.maximum(own - angle, 0)), 1.0) + 1e-9
        begin, end = np.empty(coords.shape, dtype=np.int64), np.empty(coords.shape, dtype=np.int64)
        for f in np.unique(coords).tolist():
            at = np.nonzero(coords == f)
            begin[at] = np.searchsorted(self.sorted[f], low[at], "left")
            end[at] = np.searchsorted(self.sorted[f], high[at], "right")
        shortest = (end - begin).argmin(axis=1)
        width = (end - begin)[np.arange(len(some)), shortest]
        wide = width > len(self.ids) // 2
        out = {}
        for i in np.flatnonzero(~wide & (width > 0)).tolist():
            s = shortest[i]
            rows = self.lists[coords[i, s], begin[i, s]:end[i, s]]
            for j in range(focus):
                if j != s:
                    value = self.unit[rows, coords[i, j]]
                    rows = rows[(value >= low[i, j]) & (value <= high[i, j])]
            if len(rows):
                out[int(some[i])] = np.sort(rows)
        return np.concatenate((every, some[wide])), out

    def search(self, block: dict, k: int, same: bool) -> list[tuple]:
        """(anchor number, slot, rows, scores) of the best ``k`` of each range."""
        first, tops, floors = block["first"], block["top"], block["floor"]
        lowest = np.minimum.reduceat(floors, first[:-1]) if len(floors) else floors
        every, some = self.candidates(block["vectors"], lowest.astype(np.float64))
        found = []
        if len(every):
            scores = products(block["vectors"][every], self.vectors)
            for i, s in zip(every.tolist(), scores):
                found += self._best(block, i, np.arange(len(s)), s, lowest[i], k, same)
        for i, rows in some.items():
            s = products(block["vectors"][i:i + 1], self.vectors[rows])[0]
            found += self._best(block, i, rows, s, lowest[i], k, same)
        return found

    def _best(self, block, i, rows, score, lowest, k, same) -> list[tuple]:
        ok = (self.labels[rows] == block["label"][i]) == same
        ok &= (score >= lowest) & (self.ids[rows] != block["id"][i])
        rows, score = rows[ok], score[ok]
        order = np.argsort(~score, kind="stable")  # falling; rows are in order of ids
        rows, score = rows[order], score[order]
        out = []
        for at in range(block["first"][i], block["first"][i + 1]):
            a = np.searchsorted(~score, ~block["top"][at], "left")
            part = slice(a, a + k)
            good = score[part] >= block["floor"][at]
            if good.any():
                out.append((i, block["slot"][at], rows[part][good], score[part][good]))
        return out


# ---- search -----------------------------------------------------------------------------
def _block(rows: pa.RecordBatch, dim: int) -> dict | None:
    rows = rows.filter(pc.equal(rows.column("dim"), dim))
    if not rows.num_rows:
        return None
    ranges = rows.column("ranges")
    size = np.array([len(x) for x in ranges], dtype=np.int64)
    flat = ranges.flatten()
    return {"id": rows.column("anchor_id").to_numpy(), "key": rows.column("anchor_key").to_numpy(),
            "label": rows.column("label").to_numpy(),
            "vectors": _matrix(rows.column("vector")) if dim else np.zeros((rows.num_rows, 0)),
            "first": np.concatenate(([0], np.cumsum(size))),
            **{c: flat.field(c).to_numpy(zero_copy_only=False) for c in ("slot", "top", "floor")}}


def _searcher(path: str, k: int, same: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pyarrow.fs as pafs
        import pyarrow.parquet as pq

        fs, base = _open_fs(path)
        files = sorted(i.path for i in fs.get_file_info(pafs.FileSelector(base))
                       if i.base_name.endswith(".parquet"))
        for batch in batches:
            for at in range(batch.num_rows):
                bucket = Bucket(batch.slice(at, 1).to_pylist()[0])
                for name in files:
                    with fs.open_input_file(name) as file:
                        for rows in pq.ParquetFile(file).iter_batches(batch_size=ANCHOR_ROWS):
                            block = _block(rows, bucket.dim)
                            if block is not None:
                                yield _batch(bucket, block, bucket.search(block, k, same))

    return run


def _batch(bucket: Bucket, block: dict, found: list[tuple]) -> pa.RecordBatch:
    sizes = [len(f[2]) for f in found]
    who = np.repeat(np.array([f[0] for f in found], dtype=np.int64), sizes)
    rows = np.concatenate([np.zeros(0, dtype=np.int64), *[f[2] for f in found]]).astype(np.int64)
    return pa.RecordBatch.from_arrays(
        [pa.array(block["id"][who]), pa.array(block["key"][who]),
         pa.array(np.repeat(np.array([f[1] for f in found], dtype=np.int32), sizes)),
         pa.array(bucket.ids[rows]),
         pa.array(np.concatenate([np.zeros(0, dtype=np.int64), *[f[3] for f in found]]))],
        names=["anchor_id", "anchor_key", "slot", "vec_id", "score"])


def found_between(index: DataFrame, begin: int, end: int, path: str, k: int, same: bool) -> DataFrame:
    """Best rows of every range in each bucket of these ranks, before they are merged."""
    return (index.where((F.col("rank") >= begin) & (F.col("rank") < end))
            .repartition(end - begin, "rank").mapInArrow(_searcher(path, k, same), FOUND))


def search(index: DataFrame, ranks: int, anchors: DataFrame, ranges: DataFrame, k: int,
           same: bool) -> DataFrame:
    """anchor_id, anchor_key, slot, vec_id, score, rank: for every row of ``ranges``
    (anchor_id, anchor_key, slot, floor, top) the best ``k`` rows with
    floor <= score <= top and the anchor's label (``same``) or another one."""
    spark = index.sparkSession
    best = Window.partitionBy(*KEYS).orderBy(F.col("score").desc(), "vec_id")
    found, begin, size = None, 0, FIRST_ROUND
    while begin < ranks:
        asked = ranges.groupBy("anchor_id", "anchor_key").agg(
            F.collect_list(F.struct("slot", "floor", "top")).alias("ranges"))
        path = scratch_path(spark, "negatives-anchors")
        (anchors.join(asked, ["anchor_id", "anchor_key"])
         .select("anchor_id", "anchor_key", "label", "vector", F.size("vector").alias("dim"), "ranges")
         .write.parquet(path))
        end = min(ranks, begin + size)
        now = found_between(index, begin, end, path, k, same)
        every = now if found is None else now.unionByName(found.drop("rank"))
        found = written(every.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k),
                        "negatives-found")
        if end < ranks:  # what is worse than the k-th best found is asked for no more
            last = found.where(F.col("rank") == k).select(*KEYS, F.col("score").alias("_least"))
            ranges = written(ranges.join(last, KEYS, "left").select(
                *KEYS, F.greatest("floor", F.coalesce("_least", "floor")).alias("floor"), "top"),
                "negatives-ranges")
        begin, size = end, size * GROWTH
    if found is None:
        return spark.createDataFrame([], FOUND + ", rank int")
    return found


def hard_negatives(vectors: DataFrame, is_anchor: Column, positives: int = 5, negatives: int = 5,
                   scale: float = 256.0, low: int = 80, id_col: str = "vec_id",
                   label_col: str = "label", vec_col: str = "embedding",
                   bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score: for each
    row of ``vectors`` that ``is_anchor`` selects and each of its ``positives`` best rows
    of the same label, the ``negatives`` best rows of other labels with
    ``low`` * positive_score <= 100 * negative_score <= 100 * positive_score."""
    rows = usable(vectors, is_anchor, scale, id_col, label_col, vec_col)
    index, ranks = build_index(rows, bucket_rows)
    anchors = rows.where("anchor").select(
        F.col("vec_id").alias("anchor_id"), F.xxhash64("label", "vector").alias("anchor_key"), "label",
        "vector").dropDuplicates()
    anchors = written(anchors, "negatives-anchors")
    everything = anchors.select("anchor_id", "anchor_key", F.lit(0).alias("slot"),
                                F.lit(LEAST).alias("floor"), F.lit(MOST).alias("top"))
    near = search(index, ranks, anchors, everything, positives, same=True)
    near = near.select("anchor_id", "anchor_key", F.col("rank").cast("int").alias("slot"),
                       F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"))
    wide = F.col("positive_score").cast("decimal(20,0)")
    floor = F.ceil(wide * F.lit(low).cast("decimal(3,0)") / F.lit(100).cast("decimal(3,0)"))
    ranges = near.where("positive_score >= 0").select(*KEYS, floor.cast("long").alias("floor"),
                                                      F.col("positive_score").alias("top"))
    far = search(index, ranks, anchors, ranges, negatives, same=False)
    return far.withColumnRenamed("vec_id", "negative_id").withColumnRenamed("score", "negative_score").join(
        near, KEYS).select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"),
                           "negative_id", "positive_score", "negative_score")


def op13_negatives(spark, sf_dir):
    rows = table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(rows.withColumn("label", label), F.col("vec_id") % 100 == 0)


OP13_SQL = r"""
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS q
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS vec_id, a.label = b.label AS same,
         CAST(list_dot_product(a.q, b.q) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id <> b.vec_id
  WHERE a.vec_id % 100 = 0),
p AS (
  SELECT * FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT p.anchor_id, p.vec_id AS positive_id,
       CAST(row_number() OVER (PARTITION BY p.anchor_id, p.vec_id ORDER BY n.score DESC, n.vec_id)
            AS INTEGER) AS rank,
       n.vec_id AS negative_id, p.score AS positive_score, n.score AS negative_score
FROM p JOIN s n ON n.anchor_id = p.anchor_id AND NOT n.same
 AND 80 * p.score <= 100 * n.score AND 100 * n.score <= 100 * p.score
QUALIFY rank <= 5
"""
