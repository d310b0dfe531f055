"""Toxicity by a linear-chain conditional random field over words.

Training.  A bounded sample of labelled documents (``train_docs`` and ``train_bytes``
of each label, whole texts in the order of hashes of their ids; near copies among them
count once) gives
token labels: in a toxic document, a word is toxic if it, or one of its beginnings of
four to eight letters, is much commoner in toxic than in clean documents.  A two-label
chain per sentence is then fitted to the tokens of all sampled documents by
gradient ascent on the penalised likelihood: what is observed minus what is expected,
of every feature from the marginals and of every pair of neighbouring labels from the
pairwise marginals, both of one forward and one backward sweep, with a step of its own
for each parameter (Adagrad); features are the word and those beginnings.  Texts are
learnt from whole; memory is bounded by the sample's bytes.  A logistic
curve over two summaries of a document's marginals maps them to a score; it is fitted
to whole texts under the weights that scoring uses.

Scoring.  Every whole text of every document: marginals of all words by one
forward and one backward sweep over all sentences of a batch together; the score
is the curve at (log of one plus the marginals of at least 0.5, the largest
marginal); neighbouring words of marginal 0.5 or more form the offending spans
(code points, end exclusive).  Scoring shuffles nothing and holds one batch.

Inputs of a score are the text alone.  Defined results: null or empty text
scores like a text without words; a label that is null is no label; of several
labels of one id the largest counts; repeated rows are scored each for itself;
without labels of both kinds the score is the share of toxic labels (0 without
any); an empty table gives no rows; other columns are kept, and columns added
here replace their namesakes.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartwise.llm.common import table

TOKEN = re.compile(r"[^\W\d_]+|[.!?\n]")
STOPS = frozenset(".!?\n")
BEGINNINGS = (4, 5, 6, 7, 8)
WIDTH = 1 + len(BEGINNINGS)  # features of a word at most
CACHE_WORDS = 100_000   # emissions remembered per task
TRAIN_BYTES = 32 << 20  # of texts of each label in the sample
RIDGE = 0.05            # penalty of the likelihood: half of it times the squared weights
BATCH_TOKENS = 1 << 18  # tokens swept at once (a longer text is swept alone)


@dataclass
class Model:
    """Emission weights by feature, transition weights, and the score's curve."""

    weights: dict = field(default_factory=dict)
    bias: float = -10.0
    trans: np.ndarray = field(default_factory=lambda: np.zeros((2, 2)))
    curve: tuple = (0.0, 0.0, 0.0)
    constant: float | None = None

    def emission(self, word: str) -> float:
        get = self.weights.get
        return self.bias + sum(get(f, 0.0) for f in features(word))


def features(word: str) -> list[str]:
    """The word, and its beginnings of four to eight letters (with a mark, and
    shorter than the word): inflected forms share them."""
    low = word.lower()
    return [low, *[low[:n] + "*" for n in BEGINNINGS if len(low) > n]]


# ---- the chain ---------------------------------------------------------------
def chains(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and lengths of the sentences in emissions where NaN is a stop."""
    word = ~np.isnan(values)
    edge = np.diff(np.concatenate(([0], word.astype(np.int8), [0])))
    begin = np.flatnonzero(edge == 1)
    return begin, np.flatnonzero(edge == -1) - begin


@dataclass
class Sweeps:
    """Ratios of label 1 to label 0 at every place: of the emission, of all before the
    place and itself, and of all behind it; and the log of each chain's normaliser."""

    e: np.ndarray
    forward: np.ndarray
    back: np.ndarray
    log_z: float
    trans: np.ndarray

    def marginals(self) -> np.ndarray:
        """P(label 1) of every place (0 outside of chains)."""
        ratio = self.forward * self.back
        return ratio / (1.0 + ratio)

    def pairs(self, follows: np.ndarray) -> np.ndarray:
        """Expected number of each pair of labels over places ``follows`` and the next."""
        f, behind = self.forward[follows], (self.e * self.back)[follows + 1]
        (t00, t01), (t10, t11) = np.exp(self.trans)
        joint = np.stack([np.full(len(f), t00), t01 * behind, t10 * f, t11 * f * behind])
        return (joint / joint.sum(axis=0)).sum(axis=1).reshape(2, 2)


def sweeps(emissions: np.ndarray, begin: np.ndarray, length: np.ndarray, trans: np.ndarray) -> Sweeps:
    """One forward and one backward sweep; all chains advance together, longest first."""
    forward, behind = np.zeros(len(emissions)), np.ones(len(emissions))
    e = np.exp(np.clip(np.nan_to_num(emissions), -30, 30))
    if not len(begin):
        return Sweeps(e, forward, behind, 0.0, trans)
    order = np.argsort(-length, kind="stable")
    begin, length = begin[order], length[order]
    (t00, t01), (t10, t11) = np.exp(trans)
    active = len(length) - np.searchsorted(length[::-1], np.arange(length[0]), side="right")
    r = e[begin]
    forward[begin] = r
    log_z = 0.0
    for step in range(1, int(length[0])):
        k = active[step]
        at = begin[:k] + step
        scale = t00 + r[:k] * t10
        log_z += np.log(scale).sum()
        r = e[at] * (t01 + r[:k] * t11) / scale
        forward[at] = r
    log_z += np.log1p(forward[begin + length - 1]).sum()
    back = np.ones(len(begin))
    for step in range(int(length[0]) - 1, -1, -1):
        k = active[step]
        at = begin[:k] + step
        behind[at] = back[:k]
        ahead = e[at] * back[:k]
        back[:k] = (t10 + t11 * ahead) / (t00 + t01 * ahead)
    return Sweeps(e, forward, behind, log_z, trans)


def marginals(emissions: np.ndarray, begin: np.ndarray, length: np.ndarray,
              trans: np.ndarray) -> np.ndarray:
    """P(label 1) of every place of every chain."""
    return sweeps(emissions, begin, length, trans).marginals()


# ---- training ------------------------------------------------------------------
def _sample(docs: DataFrame, labels: DataFrame, per_label: int, most_bytes: int, id_col: str,
            text_col: str, label_col: str) -> list[tuple[str, int]]:
    """At most ``per_label`` whole texts of each label, those of smallest id hash, as
    long as they hold ``most_bytes`` together (the first is taken whatever its size)."""
    known = (labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull())
             .groupBy(F.col(id_col).alias("_id")).agg(F.max(label_col).alias("_y")))
    chosen = None
    for y in (0, 1):
        own = (known.where(F.col("_y") == y).orderBy(F.xxhash64("_id", F.lit(11)), "_id")
               .limit(per_label))
        chosen = own if chosen is None else chosen.unionByName(own)
    # at most 2 * per_label ids: a proven bound
    rows = (docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
            .join(F.broadcast(chosen), "_id").where(F.length("_text") > 0)
            .groupBy("_id", "_y").agg(F.max("_text").alias("_text")))
    first = Window.partitionBy("_y").orderBy(F.xxhash64("_id", F.lit(11)), "_id")
    size = F.sum(F.octet_length("_text")).over(first.rowsBetween(Window.unboundedPreceding, 0))
    rows = (rows.withColumn("_size", size).withColumn("_place", F.row_number().over(first))
            .where((F.col("_size") <= most_bytes) | (F.col("_place") == 1)))
    return [(r["_text"], int(r["_y"])) for r in rows.orderBy("_id").select("_text", "_y").collect()]


def _distinct(texts: list[list[str]], labels: np.ndarray) -> list[int]:
    """Places of texts that are no near copies of earlier ones: none of four pairs
    of minimum hashes of their words agrees."""
    seen, kept = set(), []
    for i, words in enumerate(texts):
        h = np.array([hash_word(w) for w in set(words)] or [0], dtype=np.uint64)
        low = [int((h * np.uint64(2 * k + 3) ^ (h >> np.uint64(17 + k))).min()) for k in range(8)]
        pairs = [(int(labels[i]), k, low[2 * k], low[2 * k + 1]) for k in range(4)]
        if not any(p in seen for p in pairs):
            kept.append(i)
        seen.update(pairs)
    return kept


def hash_word(word: str) -> int:
    """A hash that does not change between runs, unlike ``hash``."""
    h = 1469598103934665603
    for b in word.encode():
        h = (h ^ b) * 1099511628211 & (1 << 64) - 1
    return h


def token_labels(texts: list[list[str]], y: np.ndarray, lift: float = 5.0,
                 error: float = 0.5) -> set[str]:
    """Features that mark a word of a toxic document as toxic: at least ``lift``
    times commoner in toxic documents, and more than chance explains (Chernoff's
    bound on the binomial tail, ``error`` shared among all features)."""
    counts = [Counter(), Counter()]
    for words, label in zip(texts, y):
        counts[label].update({f for w in set(words) if w not in STOPS for f in features(w)})
    n1, n0 = max(1, int(y.sum())), max(1, int((y == 0).sum()))
    share = n1 / (n1 + n0)
    needed = np.log(max(2, len(counts[1])) / error)

    def evidence(c: int, clean: int) -> float:
        a = c / (c + clean)
        rest = 0.0 if a == 1 else (1 - a) * np.log((1 - a) / (1 - share))
        return (c + clean) * (a * np.log(a / share) + rest)

    return {f for f, c in counts[1].items()
            if (c / n1) / ((counts[0][f] + 0.5) / n0) >= lift
            and evidence(c, counts[0][f]) >= needed}


@dataclass
class Tokens:
    """The sampled tokens: words' numbers, features of words, stops, labels, chains."""

    tokens: np.ndarray
    feats: np.ndarray
    stop: np.ndarray
    target: np.ndarray
    begin: np.ndarray
    length: np.ndarray


def likelihood(data: Tokens, w: np.ndarray, bias: float, trans: np.ndarray):
    """The penalised log likelihood of the labels, and its gradient for the weights
    (number 0 is no feature), the bias and the transitions."""
    inner = ~data.stop
    emission = (bias + w[data.feats].sum(axis=1))[data.tokens]
    found = sweeps(np.where(data.stop, np.nan, emission), data.begin, data.length, trans)
    follows = np.flatnonzero(inner[1:] & inner[:-1])
    label = data.target.astype(np.int64)
    observed = np.bincount(2 * label[follows] + label[follows + 1], minlength=4).reshape(2, 2)
    value = (emission * data.target)[inner].sum() + (observed * trans).sum() - found.log_z
    gap = np.where(inner, data.target - found.marginals(), 0.0)
    of_word = np.bincount(data.tokens, weights=gap, minlength=len(data.feats))
    grad = sum(np.bincount(data.feats[:, k], weights=of_word, minlength=len(w)) for k in range(WIDTH))
    grad[0] = 0.0
    return (value - RIDGE / 2 * ((w * w).sum() + (trans * trans).sum()),
            (grad - RIDGE * w, np.array([gap.sum()]), observed - found.pairs(follows) - RIDGE * trans))


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "toxic", train_docs: int = 1500, train_bytes: int = TRAIN_BYTES,
          rounds: int = 40) -> Model:
    """Fit the chain on a bounded sample: the whole texts of ``train_docs``
    documents, or ``train_bytes`` of them, of each label."""
    rows = _sample(docs, labels, train_docs, train_bytes, id_col, text_col, label_col)
    y = np.array([r[1] for r in rows], dtype=np.int64)
    if len(set(y.tolist())) < 2:
        return Model(constant=float(y.mean()) if len(y) else 0.0)
    # tokens as numbers of words; the words of each text once
    place: dict[str, int] = {"\n": 0}
    texts = []
    for text, _ in rows:
        found = [place.setdefault(m.group(), len(place)) for m in TOKEN.finditer(text)]
        texts.append(np.array([*found, 0], dtype=np.int32))
    vocabulary = list(place)
    words = [[vocabulary[i] for i in np.unique(t).tolist()] for t in texts]
    kept = _distinct(words, y)
    texts, words, y = [texts[i] for i in kept], [words[i] for i in kept], y[kept]
    marks = token_labels(words, y)
    # features of words as columns: feature numbers (0: none), mark, stop
    number: dict[str, int] = {}
    feats = np.zeros((len(vocabulary), WIDTH), dtype=np.int64)
    marked, stops = np.zeros(len(vocabulary), dtype=bool), np.zeros(len(vocabulary), dtype=bool)
    for i, word in enumerate(vocabulary):
        fs = [] if word in STOPS else features(word)
        feats[i, :len(fs)] = [number.setdefault(f, len(number) + 1) for f in fs]
        marked[i], stops[i] = any(f in marks for f in fs), word in STOPS
    doc = np.repeat(np.arange(len(texts)), [len(t) for t in texts])
    tokens = np.concatenate(texts)
    stop = stops[tokens]
    target = (marked[tokens] & (y[doc] == 1)).astype(float)
    begin, length = chains(np.where(stop, np.nan, 0.0))
    data = Tokens(tokens, feats, stop, target, begin, length)
    w, bias, trans = np.zeros(len(number) + 1), -4.0, np.zeros((2, 2))
    sums = [np.zeros_like(w), np.zeros(1), np.zeros((2, 2))]
    for turn in range(rounds):
        _, grads = likelihood(data, w, bias, trans)
        moves = []
        for total, grad in zip(sums, grads):  # a step for each parameter (Adagrad)
            total += grad * grad
            moves.append(grad / np.sqrt(total + 1e-6) / (1 + 0.05 * turn))
        w, bias, trans = w + moves[0], bias + 0.5 * float(moves[1][0]), trans + 0.5 * moves[2]
    often = np.bincount(tokens, weights=~stop, minlength=len(vocabulary))
    seen = sum(np.bincount(feats[:, k], weights=often, minlength=len(w)) for k in range(WIDTH))
    w[(np.abs(w) <= 0.01) | (seen <= 1)] = 0.0
    weights = {f: float(w[i]) for f, i in number.items() if w[i]}
    e = (bias + w[feats].sum(axis=1))[tokens]  # as the scorer has them
    p = marginals(np.where(stop, np.nan, e), begin, length, trans)
    x1, x2 = _summaries(p, doc, len(y))
    return Model(weights, float(bias), trans, _curve(x1, x2, y))


def _summaries(p: np.ndarray, doc: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    strong = np.bincount(doc, weights=np.where(p >= 0.5, p, 0.0), minlength=n)
    best = np.zeros(n)
    np.maximum.at(best, doc, p)
    return np.log1p(strong), best


def _curve(x1: np.ndarray, x2: np.ndarray, y: np.ndarray) -> tuple[float, float, float]:
    """Logistic regression by Newton steps with a small ridge."""
    x = np.stack([np.ones(len(y)), x1, x2], axis=1)
    beta = np.zeros(3)
    for _ in range(25):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        h = (x * (p * (1 - p))[:, None]).T @ x + 0.1 * np.eye(3)
        beta = beta + np.linalg.solve(h, x.T @ (y - p) - 0.1 * beta)
    return tuple(float(b) for b in beta)


# ---- scoring ---------------------------------------------------------------------
_SPANS = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))


def _spans(text: str, p: np.ndarray) -> list[dict]:
    """Offsets of runs of tokens with marginal 0.5 or more."""
    out: list[dict] = []
    last = -2
    for i, m in enumerate(TOKEN.finditer(text)):
        if p[i] >= 0.5:
            if last == i - 1:
                out[-1]["end"] = m.end()
            else:
                out.append({"start": m.start(), "end": m.end()})
            last = i
    return out


def scorer(model: Model, text_name: str, own: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, float] = {s: float("nan") for s in STOPS}

        def emissions(words: list[str]) -> list[float]:
            try:
                return [known[w] for w in words]
            except KeyError:
                if len(known) > CACHE_WORDS:
                    known.clear()
                    known.update({s: float("nan") for s in STOPS})
                for w in words:
                    if w not in known:
                        known[w] = model.emission(w)
                return [known[w] for w in words]

        def sweep(texts: list[str], words: list[list[float]]) -> list[tuple]:
            counts = np.array([len(w) + 1 for w in words])
            flat: list[float] = []
            for w in words:
                flat += w
                flat.append(float("nan"))  # no chain goes on into the next text
            values = np.array(flat)
            p = marginals(values, *chains(values), model.trans)
            x1, x2 = _summaries(p, np.repeat(np.arange(len(words)), counts), len(words))
            c = model.curve
            score = 1 / (1 + np.exp(-np.clip(c[0] + c[1] * x1 + c[2] * x2, -30, 30)))
            first = np.cumsum(counts) - counts
            return [(float(s), _spans(t, p[a:a + n]) if best >= 0.5 else [])
                    for s, t, a, n, best in zip(score, texts, first.tolist(), counts.tolist(), x2)]

        for batch in (whole.slice(at, 1000) for whole in batches
                      for at in range(0, whole.num_rows, 1000)):
            names = batch.schema.names
            results, texts, words, room = [], [], [], 0
            for value in batch.column(names.index(text_name)):
                text = value.as_py() or ""
                if model.constant is not None:
                    results.append((model.constant, []))
                    continue
                texts.append(text)
                words.append(emissions(TOKEN.findall(text)))
                room += len(words[-1])
                if room >= BATCH_TOKENS:
                    results += sweep(texts, words)
                    texts, words, room = [], [], 0
            if texts:
                results += sweep(texts, words)
            score = [r[0] for r in results]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(names.index(c)) for c in own], pa.array(score, pa.float64()),
                 pa.array([int(s >= 0.5) for s in score], pa.int32()),
                 pa.array([r[1] for r in results], _SPANS)],
                names=[*own, "score", "predicted", "toxic_spans"])

    return run


def score(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """``docs`` with score, predicted (score of at least 0.5) and toxic_spans."""
    own = [c for c in docs.columns if c not in ("score", "predicted", "toxic_spans")]
    schema = T.StructType([*docs.select(*own).schema.fields, *T._parse_datatype_string(
        "score double, predicted int, toxic_spans array<struct<start:int,end:int>>").fields])
    hidden = "__tox_text"  # the text, even where a namesake column is replaced
    source = docs.select(*own, F.col(text_col).alias(hidden))
    return source.mapInArrow(scorer(model, hidden, own), schema)


def held_out(id_column) -> F.Column:
    """Rows never learnt from: crc32 of the id as text, mod 5, is 0."""
    return F.coalesce(F.crc32(id_column.cast("string")) % 5 == 0, F.lit(False))


def fitted(spark, sf_dir: str) -> Model:
    """The model learnt from the labelled documents that are not held out."""
    labels = table(spark, sf_dir, "labels").where(~held_out(F.col("doc_id")))
    return train(table(spark, sf_dir, "documents"), labels)


def op4_toxicity(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = score(docs, fitted(spark, sf_dir))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted",
                         "toxic_spans")
