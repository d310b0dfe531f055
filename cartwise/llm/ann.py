"""Approximate nearest neighbours on robust-pruned directed graphs, one per shard.

Equal vectors are one node (with the ids that a result can hold); nodes are dealt
to shards of about 2 MB of vectors by a hash.  A shard's graph starts with random edges;
for every node, in batches, a greedy search from the shard's most central node
proposes neighbours, and relaxed pruning keeps the nearest and then each that is
not ``alpha`` times nearer to a kept one (two passes, alpha 1 and 1.2).  Reverse
edges are added and pruned the same way; nodes that cannot be reached get an edge
from their nearest reached node.  A query runs a beam search in every shard, by
distances in double precision, so that near copies keep their order; all that a
shard's beam holds is scored exactly (cosine, double precision, original vectors),
and the shards' best are merged.

Every vector is indexed.  Memory is bounded by a shard and a block of queries.  The
queries are a written table that each task reads in blocks; no row carries a block
or a shard to another task.  Shards are searched in rounds that grow fourfold; after
each, a query's ``k``-th best score so far is its floor, and later shards return
nothing below it, so that rows before the merge stay near ``4 k`` per query and round.

Defined results: vectors that are null, zero, or hold null or non-finite
components, and rows without an id, take no part; vectors of another length than
the query's are not compared; equal repeated rows are one candidate or one query;
an id with several vectors is one candidate, and asks with all of them, its best
score counts; ties go to the smaller id; a query's own id is no candidate; fewer candidates than ``k`` are
all returned if the beam meets them; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cartwise.llm.common import parquet_batches, parts_for, table, written
from cartwise.session import scratch_path

SHARD_BYTES = 2 << 20      # of vectors in double precision
FIRST_ROUND, GROWTH = 4, 4
DEGREE, SPARE = 24, 4      # edges of a node, and places for edges that join islands
BUILD_BEAM, BEAM, EXPAND = 48, 64, 4
ALPHAS = (1.0, 1.2)
BATCH = 256
QUERY_ROWS = 1024          # read at once


# ---- graph in numpy ----------------------------------------------------------
def beam_search(unit: np.ndarray, graph: np.ndarray, entry: int, queries: np.ndarray,
                beam: int) -> tuple[np.ndarray, np.ndarray]:
    """Nodes and distances (1 - cosine) of the best ``beam`` met, nearest first;
    -1 where fewer were met.  All queries advance together."""
    n, q = len(unit), len(queries)
    ids = np.full((q, beam), -1, dtype=np.int64)
    dist = np.full((q, beam), np.inf, dtype=unit.dtype)
    done = np.zeros((q, beam), dtype=bool)
    seen = np.zeros((q, n), dtype=bool)
    ids[:, 0], seen[:, entry] = entry, True
    dist[:, 0] = 1 - queries @ unit[entry]
    live = np.arange(q)
    while len(live):
        open_ = ~done[live] & (ids[live] >= 0)
        rank = np.cumsum(open_, axis=1)
        take = open_ & (rank <= EXPAND)
        some = take.any(axis=1)
        live, take = live[some], take[some]
        if not len(live):
            break
        row, col = np.nonzero(take)
        done[live[row], col] = True
        cells = np.full((len(live), EXPAND), -1, dtype=np.int64)
        cells[row, (np.cumsum(take, axis=1) - 1)[row, col]] = ids[live[row], col]
        near = np.where(cells[:, :, None] >= 0, graph[cells], -1).reshape(len(live), -1)
        near.sort(axis=1)
        fresh = near >= 0
        fresh[:, 1:] &= near[:, 1:] != near[:, :-1]
        fresh &= ~seen[live[:, None], near]
        row, col = np.nonzero(fresh)
        seen[live[row], near[row, col]] = True
        d = np.full(near.shape, np.inf, dtype=unit.dtype)
        d[row, col] = 1 - np.einsum("ij,ij->i", queries[live[row]], unit[near[row, col]])
        all_d = np.concatenate((dist[live], d), axis=1)
        all_i = np.concatenate((ids[live], np.where(fresh, near, -1)), axis=1)
        all_f = np.concatenate((done[live], np.zeros(d.shape, dtype=bool)), axis=1)
        best = np.argsort(all_d, axis=1, kind="stable")[:, :beam]
        dist[live] = np.take_along_axis(all_d, best, axis=1)
        ids[live] = np.take_along_axis(all_i, best, axis=1)
        done[live] = np.take_along_axis(all_f, best, axis=1)
    return ids, dist


def robust_prune(unit: np.ndarray, nodes: np.ndarray, cand: np.ndarray, alpha: float) -> np.ndarray:
    """Out-edges for ``nodes`` from candidates (-1: none): nearest first, dropping
    what is ``alpha`` times nearer to a kept neighbour than to the node."""
    cand = np.sort(cand, axis=1)
    bad = (cand < 0) | (cand == nodes[:, None])
    bad[:, 1:] |= cand[:, 1:] == cand[:, :-1]
    vec = unit[cand]
    own = np.sqrt(np.maximum(0, 2 - 2 * np.einsum("ij,ikj->ik", unit[nodes], vec)))
    between = np.sqrt(np.maximum(0, 2 - 2 * (vec @ vec.transpose(0, 2, 1))))
    own[bad] = np.inf
    out = np.full((len(nodes), DEGREE), -1, dtype=np.int64)
    rows = np.arange(len(nodes))
    for k in range(DEGREE):
        best = own.argmin(axis=1)
        ok = np.isfinite(own[rows, best])
        if not ok.any():
            break
        out[ok, k] = cand[rows[ok], best[ok]]
        own[(alpha * between[rows, best] <= own) & ok[:, None]] = np.inf
        own[rows, best] = np.inf
    return out


def _add_reverse(unit: np.ndarray, graph: np.ndarray, nodes: np.ndarray, alpha: float) -> None:
    source = np.repeat(nodes, DEGREE)
    target = graph[nodes, :DEGREE].ravel()
    ok = target >= 0
    order = np.argsort(target[ok], kind="stable")
    source, target = source[ok][order], target[ok][order]
    heads = np.flatnonzero(np.diff(target, prepend=-1))
    counts = np.diff(np.append(heads, len(target)))
    for at in range(0, len(heads), BATCH):
        h, c = heads[at:at + BATCH], counts[at:at + BATCH]
        into = target[h]
        new = np.full((len(h), int(c.max())), -1, dtype=np.int64)
        row = np.repeat(np.arange(len(h)), c)
        col = np.arange(len(row)) - np.repeat(np.cumsum(c) - c, c)
        new[row, col] = source[np.repeat(h, c) + col]
        graph[into, :DEGREE] = robust_prune(
            unit, into, np.concatenate((graph[into, :DEGREE], new), axis=1), alpha)


def build_graph(unit: np.ndarray, seed: int) -> tuple[np.ndarray, int]:
    """Graph (rows of out-edges, -1: none) and entry node over unit vectors."""
    n = len(unit)
    rng = np.random.default_rng(seed)
    graph = np.full((n, DEGREE + SPARE), -1, dtype=np.int64)
    entry = int((unit @ unit.mean(axis=0)).argmax())
    if n <= DEGREE + 1:
        everyone = np.arange(n)
        for i in range(n):
            graph[i, :n - 1] = np.delete(everyone, i)
        return graph, entry
    graph[:, :DEGREE] = (np.arange(n)[:, None] + rng.integers(1, n, (n, DEGREE))) % n
    for alpha in ALPHAS:
        order = rng.permutation(n)
        for at in range(0, n, BATCH):
            nodes = order[at:at + BATCH]
            met, _ = beam_search(unit, graph, entry, unit[nodes], BUILD_BEAM)
            graph[nodes, :DEGREE] = robust_prune(
                unit, nodes, np.concatenate((met, graph[nodes, :DEGREE]), axis=1), alpha)
            _add_reverse(unit, graph, nodes, alpha)
    _join_islands(unit, graph, entry)
    return graph, entry


def _join_islands(unit: np.ndarray, graph: np.ndarray, entry: int) -> None:
    """Every node can be reached from the entry: an island gets an edge from the
    nearest reached node that has a spare place."""
    n = len(unit)
    reached = np.zeros(n, dtype=bool)
    front = np.array([entry])
    while True:
        while len(front):
            reached[front] = True
            near = graph[front].ravel()
            near = np.unique(near[near >= 0])
            front = near[~reached[near]]
        lost = np.flatnonzero(~reached)
        if not len(lost):
            return
        node = lost[0]
        spare = np.flatnonzero(reached & (graph[:, DEGREE:] < 0).any(axis=1))
        if not len(spare):
            spare = np.array([entry])
        best = spare[(unit[spare] @ unit[node]).argmax()]
        graph[best, DEGREE + int((graph[best, DEGREE:] >= 0).sum()) % SPARE] = node
        front = np.array([node])


# ---- index -------------------------------------------------------------------
INDEX = ("dim int, shard int, entry int, ids binary, counts binary, vectors binary, graph binary")


def _unit(vectors: np.ndarray) -> np.ndarray:
    peak = np.abs(vectors).max(axis=1)[:, None]  # squares of large numbers would overflow
    return vectors / peak / np.linalg.norm(vectors / peak, axis=1)[:, None]


def _build(key, rows):
    vectors = np.array(rows.column("embedding").to_pylist(), dtype=np.float64)
    order = np.argsort([i[0] for i in rows.column("ids").to_pylist()], kind="stable")
    vectors = vectors[order]
    ids = rows.column("ids").to_pylist()
    ids = [ids[i] for i in order.tolist()]
    dim, shard = key[0].as_py(), key[1].as_py()
    graph, entry = build_graph(_unit(vectors), seed=shard)
    return pa.table({
        "dim": pa.array([dim], pa.int32()), "shard": pa.array([shard], pa.int32()),
        "entry": pa.array([entry], pa.int32()),
        "ids": [np.array([x for i in ids for x in i], dtype=np.int64).tobytes()],
        "counts": [np.array([len(i) for i in ids], dtype=np.int32).tobytes()],
        "vectors": [vectors.tobytes()], "graph": [graph.astype(np.int32).tobytes()]})


def usable(df: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(vec_id, embedding as doubles) of the rows that take part."""
    v = F.col(vec_col).cast("array<double>")
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    zero = ~F.exists(v, lambda x: x != 0)
    return (df.where(F.col(id_col).isNotNull() & F.col(vec_col).isNotNull())
            .select(F.col(id_col).cast("long").alias("vec_id"), v.alias("embedding"))
            .where(~bad & ~zero))


def build_index(vectors: DataFrame, k: int, id_col: str = "vec_id", vec_col: str = "embedding",
                shard_bytes: int = SHARD_BYTES) -> tuple[DataFrame, int]:
    """Shards' graphs as a written table, and the number of shards.  ``k``: the
    most neighbours a search will ask for (ids kept of equal vectors: k + 1)."""
    rows = usable(vectors, id_col, vec_col)
    n_bytes = rows.agg(F.sum(F.size("embedding").cast("long") * 8)).first()[0]
    shards = parts_for(n_bytes or 0, shard_bytes)
    order = Window.partitionBy("embedding").orderBy("vec_id")
    nodes = (rows.withColumn("_r", F.dense_rank().over(order)).where(F.col("_r") <= k + 1)
             .groupBy("embedding").agg(F.sort_array(F.collect_set("vec_id")).alias("ids"))
             .select("ids", "embedding", F.size("embedding").alias("dim"),
                     F.pmod(F.xxhash64(F.element_at("ids", 1)), F.lit(shards)).cast("int").alias("shard")))
    # a fixed number of partitions: graphs are much work for few bytes, and must not
    # be merged into few tasks for their size
    graphs = nodes.repartition(shards, "dim", "shard").groupBy("dim", "shard").applyInArrow(_build, INDEX)
    return written(graphs, "ann-index"), shards


# ---- search -----------------------------------------------------------------
class Shard:
    def __init__(self, row: dict):
        self.dim, self.entry = row["dim"], row["entry"]
        self.vectors = np.frombuffer(row["vectors"], dtype=np.float64).reshape(-1, self.dim)
        self.graph = np.frombuffer(row["graph"], dtype=np.int32).reshape(len(self.vectors), -1).astype(np.int64)
        self.counts = np.frombuffer(row["counts"], dtype=np.int32)
        self.ids = np.frombuffer(row["ids"], dtype=np.int64)
        self.first = np.cumsum(self.counts) - self.counts
        self.unit = _unit(self.vectors)
        self.norm = np.sqrt((self.vectors * self.vectors).sum(axis=1))

    def search(self, queries: np.ndarray, names: np.ndarray, floors: np.ndarray, k: int, beam: int):
        """(query id, vec_id, score) arrays: the best ``k`` found that reach the floor,
        for some queries at a time."""
        # ids of several nodes: so many nodes more may hold no k + 1 ids
        nodes = np.sort(np.unique(self.ids, return_counts=True)[1])[-k:]
        spare = int(nodes.sum()) - len(nodes)
        step = max(1, BATCH * beam // (beam + spare))
        for at in range(0, len(queries), step):
            q, own = queries[at:at + step], names[at:at + step]
            met, _ = beam_search(self.unit, self.graph, self.entry, _unit(q), max(beam, k + 1) + spare)
            row, col = np.nonzero(met >= 0)
            node = met[row, col]
            norms = np.sqrt((q * q).sum(axis=1))
            score = (q[row] * self.vectors[node]).sum(axis=1) / (norms[row] * self.norm[node])
            many = self.counts[node]
            at_id = np.repeat(self.first[node] - (np.cumsum(many) - many), many) + np.arange(many.sum())
            row, score, cand = np.repeat(row, many), np.repeat(score, many), self.ids[at_id]
            ok = (cand != own[row]) & (score >= floors[at:at + step][row])
            row, score, cand = row[ok], score[ok], cand[ok]
            order = np.lexsort((cand, -score, row))
            row, score, cand = row[order], score[order], cand[order]
            if spare:  # the best of an id's nodes
                best = np.sort(np.unique(np.stack((row, cand)), axis=1, return_index=True)[1])
                row, score, cand = row[best], score[best], cand[best]
            top = np.arange(len(row)) - np.searchsorted(row, row) < k
            yield own[row[top]], cand[top], score[top]


def _searcher(path: str, k: int, beam: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                shard = Shard(batch.slice(at, 1).to_pylist()[0])
                for rows in parquet_batches(path, QUERY_ROWS):
                    rows = rows.filter(pc.equal(rows.column("dim"), shard.dim))
                    if not rows.num_rows:
                        continue
                    q = rows.column("embedding").flatten().to_numpy().reshape(-1, shard.dim)
                    for found in shard.search(q, rows.column("vec_id").to_numpy(),
                                              rows.column("floor").to_numpy(), k, beam):
                        yield pa.RecordBatch.from_arrays([pa.array(x) for x in found],
                                                         names=["query_id", "vec_id", "score"])

    return run


def search(index: DataFrame, shards: int, queries: DataFrame, k: int, id_col: str = "vec_id",
           vec_col: str = "embedding", beam: int = BEAM) -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` nearest found of every query."""
    asked = written(usable(queries, id_col, vec_col).dropDuplicates()
                    .withColumn("dim", F.size("embedding")), "ann-queries")
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    found, begin, size = None, 0, FIRST_ROUND
    while begin < shards:
        path = scratch_path(index.sparkSession, "ann-asked")
        floor = F.lit(float("-inf"))
        if found is not None:  # what is worse than the k-th best found is no result
            least = found.where(F.col("rank") == k).select("query_id", F.col("score").alias("least"))
            now = asked.join(least, F.col("vec_id") == F.col("query_id"), "left")
            floor = F.coalesce("least", floor)
        else:
            now = asked
        now.select("vec_id", "embedding", "dim", floor.alias("floor")).write.parquet(path)
        end = min(shards, begin + size)
        new = (index.where((F.col("shard") >= begin) & (F.col("shard") < end))
               .repartition(end - begin, "shard")
               .mapInArrow(_searcher(path, k, beam), "query_id long, vec_id long, score double"))
        every = new if found is None else new.unionByName(found.drop("rank"))
        # an id may hold several vectors, as a query and in several shards
        every = every.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
        found = written(every.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k),
                        "ann-found")
        begin, size = end, size * GROWTH
    return found.select("query_id", "rank", "vec_id", "score")


def op1_ann(spark, sf_dir):
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    index, shards = build_index(vectors, 5)
    return search(index, shards, vectors.where(F.col("vec_id") % 50 == 0), 5)
