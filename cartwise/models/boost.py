"""Gradient-boosted trees: Spark ML's algorithm, its passes over a round's sample only.

Spark ML makes three passes over all rows for a tree of depth 3, whatever share of
them the round samples, and a fit of more rounds begins anew.  ``Booster`` grows the
same trees (the same split candidates, samples, features by node, gains and leaves,
up to the order of sums), and goes on from the rounds that it has.

Rows are written once as blocks: a byte a feature (the bin among Spark ML's own split
candidates), the label and the margin of the rounds before.  Every ``ROUNDS_AT_ONCE``
rounds one pass over the blocks adds their trees to the margins and writes them anew,
beside the samples of the rounds to come.  A level of a tree is then a job over its
round's sample: the tasks add the few trees since that pass and count by (node,
feature, bin); the driver gets these counts (some 55 kB a task) and chooses the splits.

Samples are those of ``BaggedPoint`` (one ``XORShiftRandom`` for each partition and
round).  Its steps are linear over bits, so a sequence is made from many places at once.
"""

from __future__ import annotations

import math
import struct
import sys
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext, cloudpickle
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwise.session import delete_path, scratch_path

# executors need not import this module
cloudpickle.register_pickle_by_value(sys.modules[__name__])

ROUNDS_AT_ONCE = 16
BLOCK_ROWS = 1 << 16
LEAST_IMPURITY = 2.0 ** -52  # a node of less is a leaf
STATE = -1  # the "round" under which the blocks themselves are written
BLOCKS = "round int, part int, start long, bins binary, labels binary, margins binary"
LANE_BITS = 9  # steps of the generator from one lane to the next: 2 ** 9


# ---- Spark's random numbers ----------------------------------------------------------
def hash_seed(seed: int) -> int:
    """State of a new ``XORShiftRandom``."""
    def murmur(data: bytes, h: int) -> int:
        for k in struct.unpack("<2I", data):
            k = k * 0xCC9E2D51 & 0xFFFFFFFF
            k = (k << 15 | k >> 17) & 0xFFFFFFFF
            h ^= k * 0x1B873593 & 0xFFFFFFFF
            h = (h << 13 | h >> 19) & 0xFFFFFFFF
            h = h * 5 + 0xE6546B64 & 0xFFFFFFFF
        h ^= len(data)
        h = (h ^ h >> 16) * 0x85EBCA6B & 0xFFFFFFFF
        h = (h ^ h >> 13) * 0xC2B2AE35 & 0xFFFFFFFF
        return h ^ h >> 16

    data = struct.pack(">q", seed)
    low = murmur(data, 0x3C074A61)
    return murmur(data, low) << 32 | low


def _step(x: np.ndarray) -> np.ndarray:
    x = x ^ (x << np.uint64(21))
    x ^= x >> np.uint64(35)
    return x ^ (x << np.uint64(4))


def _times(columns: np.ndarray, x: np.ndarray) -> np.ndarray:
    """The bit matrix of ``columns`` times every number of ``x``, a byte at a time."""
    out = np.zeros_like(x)
    for byte in range(8):
        table = np.zeros(256, dtype=np.uint64)
        for bit in range(8):
            table[1 << bit:2 << bit] = table[:1 << bit] ^ columns[8 * byte + bit]
        out ^= table[(x >> np.uint64(8 * byte)).astype(np.uint8)]
    return out


def _powers(upto: int) -> list[np.ndarray]:
    """Bit matrices of 1, 2, 4, ... steps."""
    out = [_step(np.uint64(1) << np.arange(64, dtype=np.uint64))]
    while len(out) < upto:
        out.append(_times(out[-1], out[-1]))
    return out


def drawn(states: np.ndarray, start: int, n: int, rate: float) -> np.ndarray:
    """Which of the draws ``start`` to ``start + n`` fall below ``rate``, for each state."""
    if rate >= 1:
        return np.ones((len(states), n), dtype=bool)
    lanes = max(1, -(-2 * n >> LANE_BITS))
    powers = _powers(max(LANE_BITS + lanes.bit_length(), (2 * start).bit_length()))
    for bit in range((2 * start).bit_length()):
        if 2 * start >> bit & 1:
            states = _times(powers[bit], states)
    now, have = np.empty((len(states), lanes), dtype=np.uint64), 1
    now[:, 0] = states
    while have < lanes:
        more = min(have, lanes - have)
        now[:, have:have + more] = _times(powers[LANE_BITS + have.bit_length() - 1], now[:, :more])
        have += more
    below = np.uint64(math.ceil(rate * 2 ** 53))
    out = np.empty((1 << LANE_BITS - 1, *now.shape), dtype=bool)
    for t in range(len(out)):  # a double is the low 26 bits of one state and 27 of the next
        now = _step(now)
        high = (now & np.uint64((1 << 26) - 1)) << np.uint64(27)
        now = _step(now)
        out[t] = high + (now & np.uint64((1 << 27) - 1)) < below
    return out.transpose(1, 2, 0).reshape(len(states), -1)[:, :n]


def java_longs(seed: int) -> Iterator[int]:
    """``nextLong`` of a ``java.util.Random``."""
    state = (seed ^ 0x5DEECE66D) & (1 << 48) - 1
    signed = lambda x, bits: (x + (1 << bits - 1)) % (1 << bits) - (1 << bits - 1)
    while True:
        parts = []
        for _ in range(2):
            state = state * 0x5DEECE66D + 0xB & (1 << 48) - 1
            parts.append(signed(state >> 16, 32))
        yield signed((parts[0] << 32) + parts[1], 64)


def reservoir(n: int, k: int, seed: int) -> list[int]:
    """``k`` of the numbers below ``n``, as ``SamplingUtils`` draws them."""
    kept, state = list(range(k)), np.array([hash_seed(seed)], dtype=np.uint64)
    for item in range(k, n):
        state = _step(state)
        high = int(state[0]) & (1 << 26) - 1
        state = _step(state)
        at = int(((high << 27) + (int(state[0]) & (1 << 27) - 1)) * 2.0 ** -53 * (item + 1))
        if at < k:
            kept[at] = item
    return kept


# ---- blocks --------------------------------------------------------------------------
def predicted(tree: dict, bins: np.ndarray, node: int = 1):
    """Value of every row in a tree: node -> (feature, last bin to the left), or a value."""
    at = tree[node]
    if not isinstance(at, tuple):
        return at
    return np.where(bins[at[0]] <= at[1], predicted(tree, bins, 2 * node),
                    predicted(tree, bins, 2 * node + 1))


def _block(round_: int, part: int, start: int, bins, labels, margins) -> pa.RecordBatch:
    cells = [pa.array([round_], pa.int32()), pa.array([part], pa.int32()), pa.array([start], pa.int64()),
             *[pa.array([np.ascontiguousarray(a).tobytes()], pa.binary()) for a in (bins, labels, margins)]]
    return pa.RecordBatch.from_arrays(cells, names=[c.split()[0] for c in BLOCKS.split(", ")])


def _with_samples(part: int, start: int, bins, labels, margins, seed: int, rounds: range,
                  rate: float) -> Iterator[pa.RecordBatch]:
    """A block, and its rows in the samples of some rounds."""
    yield _block(STATE, part, start, bins, labels, margins)
    states = np.array([hash_seed(seed + m + part + 1) for m in rounds], dtype=np.uint64)
    for m, chosen in zip(rounds, drawn(states, start, len(labels), rate)):
        own = np.flatnonzero(chosen)
        if len(own):
            yield _block(m, part, start, bins[:, own], labels[own], margins[own])


def _arrays(row, features: int):
    bins = np.frombuffer(row["bins"], dtype=np.uint8).reshape(features, -1)
    return bins, np.frombuffer(row["labels"], dtype=np.int8), np.frombuffer(row["margins"])


def _binner(thresholds: list, seed: int, rounds: range, rate: float) -> Callable:
    """Blocks of a task's rows (label, features)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, start, held, room = TaskContext.get().partitionId(), 0, [], 0

        def out():
            bins = np.concatenate([h[0] for h in held], axis=1)
            labels = np.concatenate([h[1] for h in held])
            return _with_samples(part, start, bins, labels, np.zeros(len(labels)), seed, rounds, rate)

        for batch in batches:
            y = batch.column(0).to_numpy(zero_copy_only=False)
            x = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(len(y), -1)
            bins = np.empty((len(thresholds), len(y)), dtype=np.uint8)
            for k, t in enumerate(thresholds):
                bins[k] = np.searchsorted(t, x[:, k])
            held.append((bins, (2 * y - 1).astype(np.int8)))
            room += len(y)
            if room >= BLOCK_ROWS:
                yield from out()
                start, held, room = start + room, [], 0
        if room:
            yield from out()

    return run


def _advancer(features: int, trees: list, seed: int, rounds: range, rate: float) -> Callable:
    """Blocks with ``trees`` added to their margins, and the samples of the next rounds."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                bins, labels, margins = _arrays(row, features)
                for weight, tree in trees:
                    margins = margins + weight * predicted(tree, bins)
                yield from _with_samples(row["part"], row["start"], bins, labels, margins, seed, rounds, rate)

    return run


def _counter(features: int, width: int, first: bool, trees: list, growing: dict, slots: int) -> Callable:
    """Rows, sums and sums of squares of the pseudo-residuals by (node, feature, bin) of a
    task's part of a sample.  ``growing`` places a row in a node, or behind the last."""
    def run(rows) -> Iterator[np.ndarray]:
        seen = np.zeros((3, features, (slots + 1) * width))
        for row in rows:
            bins, labels, margins = _arrays(row, features)
            target = labels.astype(np.float64)
            if not first:
                for weight, tree in trees:
                    margins = margins + weight * predicted(tree, bins)
                with np.errstate(over="ignore"):  # exp may become infinite: no residual
                    target = 4.0 * labels / (1.0 + np.exp(2.0 * labels * margins))
            place = np.broadcast_to(predicted(growing, bins), labels.shape).astype(np.int32) * width
            squares = target * target
            for k in range(features):
                at = place + bins[k]
                for part, weights in enumerate((None, target, squares)):
                    seen[part, k] += np.bincount(at, weights, minlength=seen.shape[2])
        yield seen.reshape(3, features, slots + 1, width)[:, :, :slots]

    return run


# ---- trees ---------------------------------------------------------------------------
def impurity(stats) -> float:
    n, total, squares = stats
    return (squares - total * total / n) / n if n else 0.0


def best_split(counts: np.ndarray, sizes: list[int], chosen: list[int], node_impurity: float,
               least_rows: int):
    """(gain, feature, last bin to the left, left stats, right stats) of the split with the
    largest gain, the first of equal ones in the order of ``chosen``; None if there is none
    that gains.  ``counts``: stats by feature and bin."""
    best = None
    for k in chosen:
        if sizes[k] < 2:
            continue
        left = np.cumsum(counts[:, k, :sizes[k]], axis=1)
        left, right = left[:, :-1], left[:, -1:] - left[:, :-1]
        with np.errstate(invalid="ignore", divide="ignore"):
            each = [(s[2] - s[1] * s[1] / s[0]) / s[0] for s in (left, right)]
            n = left[0] + right[0]
            gain = node_impurity - left[0] / n * each[0] - right[0] / n * each[1]
        gain[(left[0] < least_rows) | (right[0] < least_rows)] = -np.inf
        at = int(np.argmax(gain))
        if gain[at] > 0 and (best is None or gain[at] > best[0]):
            best = (float(gain[at]), k, at, left[:, at].copy(), right[:, at].copy())
    return best


class Booster:
    """Boosting rounds on ``rows``, by the parameters of ``estimator``."""

    def __init__(self, rows: DataFrame, estimator: GBTClassifier):
        self.spark, self.estimator = rows.sparkSession, estimator
        self.rate, self.seed = estimator.getSubsamplingRate(), estimator.getSeed()
        self.per_node, self.thresholds = self._candidates(rows)
        self.width = 1 + max(len(t) for t in self.thresholds)
        #: node -> (feature, last bin) or a leaf's value; and node -> (stats, impurity, gain)
        self.trees: list[tuple[dict, dict]] = []
        self._rows = rows.select(F.col(estimator.getLabelCol()).cast("double"),
                                 vector_to_array(estimator.getFeaturesCol()))
        self._path, self._from = None, 0

    def _candidates(self, rows: DataFrame) -> tuple[int, list[np.ndarray]]:
        """Features of a node, and the split candidates that Spark ML takes for each."""
        jvm = self.spark._jvm
        scala = lambda package, name: getattr(getattr(package, f"{name}$"), "MODULE$")
        self.estimator._transfer_params_to_java()
        java = self.estimator._java_obj
        points = scala(jvm.org.apache.spark.ml.util, "DatasetUtils").extractInstances(
            java, rows._jdf, jvm.scala.Option.apply(2))  # checks the labels too
        algo = jvm.org.apache.spark.mllib.tree.configuration.Algo
        none = scala(jvm.scala.collection.immutable, "Map").empty()
        strategy = java.getOldBoostingStrategy(none, algo.Classification()).treeStrategy().copy()
        strategy.setAlgo(algo.Regression())
        tree = jvm.org.apache.spark.ml.tree.impl
        metadata = tree.DecisionTreeMetadata.buildMetadata(
            points, strategy, 1, self.estimator.getFeatureSubsetStrategy())
        splits = scala(tree, "RandomForest").findSplits(points, metadata, self.seed)
        return metadata.numFeaturesPerNode(), [
            np.array([s.threshold() for s in of], dtype=np.float64) for of in splits]

    def _weight(self, at: int) -> float:
        return self.estimator.getStepSize() if at else 1.0

    def _weighted(self, first: int) -> list:
        return [(self._weight(at), self.trees[at][0]) for at in range(first, len(self.trees))]

    def _read(self, round_: int) -> DataFrame:
        return (self.spark.read.schema(BLOCKS.split(", ", 1)[1])
                .parquet(f"{self._path}/round={round_}"))

    def _advance(self) -> None:
        """Write the blocks with all trees in their margins, and the next rounds' samples."""
        rounds = range(len(self.trees), len(self.trees) + ROUNDS_AT_ONCE)
        if self._path is None:
            new = self._rows.mapInArrow(_binner(self.thresholds, self.seed, rounds, self.rate), BLOCKS)
        else:
            new = self._read(STATE).mapInArrow(
                _advancer(len(self.thresholds), self._weighted(self._from), self.seed, rounds, self.rate), BLOCKS)
        path = scratch_path(self.spark, "boosting")
        new.write.partitionBy("round").parquet(path)
        self.release()
        self._path, self._from = path, len(self.trees)

    def _sample(self):
        """The next round's sample."""
        fs = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self._path}/round={len(self.trees)}")
        if not fs.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).exists(fs):
            return self.spark.sparkContext.emptyRDD()  # nobody was drawn
        return self._read(len(self.trees)).select("bins", "labels", "margins").rdd

    def _grown(self) -> tuple[dict, dict]:
        """One more tree."""
        sample, before = self._sample(), self._weighted(self._from)
        sizes = [1 + len(t) for t in self.thresholds]
        depth, least = self.estimator.getMaxDepth(), self.estimator.getMinInstancesPerNode()
        draw = java_longs(self.seed + len(self.trees))
        tree, facts, nodes = {1: 0.0}, {}, [1]
        while nodes:
            chosen = [list(range(len(sizes))) if self.per_node >= len(sizes)
                      else reservoir(len(sizes), self.per_node, next(draw)) for _ in nodes]
            # rows of finished leaves go behind the last slot
            growing = {k: v if isinstance(v, tuple) else nodes.index(k) if k in nodes else len(nodes)
                       for k, v in tree.items()}
            run = _counter(len(sizes), self.width, not self.trees, before, growing, len(nodes))
            counts = np.zeros((3, len(sizes), len(nodes), self.width))
            for part in sample.mapPartitions(run).collect():  # counts of one level, by task
                counts += part
            more = []
            for slot, node in enumerate(nodes):
                if node == 1:
                    stats = counts[:, 0, 0].sum(axis=1)
                    facts[1] = (stats, impurity(stats), None)
                    tree[1] = float(stats[1] / stats[0]) if stats[0] else 0.0
                stats, own, _ = facts[node]
                found = best_split(counts[:, :, slot], sizes, chosen[slot], own, least)
                if found is None:
                    continue
                gain, feature, last, *sides = found
                tree[node], facts[node] = (feature, last), (stats, own, gain)
                for child, side in zip((2 * node, 2 * node + 1), sides):
                    tree[child], facts[child] = float(side[1] / side[0]), (side, impurity(side), None)
                    if child.bit_length() <= depth and abs(facts[child][1]) >= LEAST_IMPURITY:
                        more.insert(0, child)
            nodes = more
        return tree, facts

    def grow(self, rounds: int) -> None:
        """Go on to ``rounds`` trees."""
        while len(self.trees) < rounds:
            if self._path is None or len(self.trees) == self._from + ROUNDS_AT_ONCE:
                self._advance()
            self.trees.append(self._grown())

    def model(self, rounds: int) -> GBTClassificationModel:
        """The first rounds as a Spark ML model."""
        gateway, jvm = self.spark.sparkContext._gateway, self.spark._jvm
        # every name below a package is a call
        ml, spark = jvm.org.apache.spark.ml, jvm.org.apache.spark
        leaf, inner, split_at = ml.tree.LeafNode, ml.tree.InternalNode, ml.tree.ContinuousSplit
        calculator, part = spark.mllib.tree.impurity.VarianceCalculator, jvm.java.util.Arrays.copyOfRange
        kind, many = ml.regression.DecisionTreeRegressionModel, len(self.thresholds)

        def doubles(values):  # sent as bytes, not one by one
            out = gateway.new_array(jvm.double, len(values))
            data = bytearray(np.asarray(values, dtype=">f8").tobytes())
            jvm.java.nio.ByteBuffer.wrap(data).asDoubleBuffer().get(out)
            return out

        every = doubles([v for _, facts in self.trees[:rounds] for stats, _, _ in facts.values()
                         for v in stats])

        def built(tree: dict, facts: dict, node: int, at: dict):
            """The node, and its prediction if it is a leaf."""
            stats, own, gain = facts[node]
            value = float(stats[1] / stats[0]) if stats[0] else 0.0
            known = calculator(part(every, 3 * at[node], 3 * at[node] + 3), int(stats[0]))
            if isinstance(tree[node], tuple):
                (left, a), (right, b) = (built(tree, facts, k, at) for k in (2 * node, 2 * node + 1))
                if a is None or a != b:  # Spark ML joins leaves of one prediction
                    feature, last = tree[node]
                    split = split_at(feature, float(self.thresholds[feature][last]))
                    return inner(value, float(own), gain, left, right, split, known), None
            return leaf(value, float(own), known), value

        trees, before = gateway.new_array(kind, rounds), 0
        for i, (tree, facts) in enumerate(self.trees[:rounds]):
            at = {node: before + k for k, node in enumerate(facts)}
            before += len(facts)
            trees[i] = kind(f"dtr_{self.estimator.uid}_{i}", built(tree, facts, 1, at)[0], many)
        self.estimator._transfer_params_to_java()
        java = ml.classification.GBTClassificationModel(
            self.estimator.uid, trees, doubles([self._weight(i) for i in range(rounds)]), many, 2)
        java.setParent(self.estimator._java_obj)
        self.estimator._java_obj.copyValues(java, ml.param.ParamMap())
        return self.estimator._copyValues(GBTClassificationModel(java))

    def release(self) -> None:
        """Delete the written blocks, if there are any."""
        if self._path:
            delete_path(self.spark, self._path)
            self._path = None


class BoostedTrees(GBTClassifier):
    """Spark ML's estimator, fitted by a ``Booster``.  ``keep()`` lets later fits go on
    from the rounds of earlier ones, for copies that differ in the number of rounds."""

    _kept: dict | None = None

    def keep(self, kept: dict) -> BoostedTrees:
        """``kept`` holds the booster between fits on the same rows; the caller releases it."""
        self._kept = kept
        return self

    def _fit(self, dataset: DataFrame) -> GBTClassificationModel:
        special = any(self.isDefined(p) for p in ("weightCol", "validationIndicatorCol"))
        if special or self.getMaxBins() > 256 or self.getMinInfoGain() or self.getMinWeightFractionPerNode():
            return super()._fit(dataset)
        booster = (self._kept or {}).get("booster") or Booster(dataset, self)
        booster.estimator = self
        try:
            booster.grow(self.getMaxIter())
            return booster.model(self.getMaxIter())
        finally:
            if self._kept is None:
                booster.release()
            else:
                self._kept["booster"] = booster
