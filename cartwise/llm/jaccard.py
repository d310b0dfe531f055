"""N-gram Jaccard self-join by grouped prefixes, down to linked classes.

A document's set is that of its distinct 5-word shingles (A-Z lowered); two
documents link when 100 * intersection >= 75 * union.  What comes out is the
smallest id reachable over links.  No link between different sets is lost, but
pairs that are connected already are not verified.

* Equal sets are one node.  Nodes with the same prefix (the smallest shingles in
  a global order, as many as a partner must share one of) and the same size are
  one group; prefixes are emitted once per group and map task.
* The order of shingles is: those frequent in a bounded sample last, then by
  hash.  Any order gives the same result; this one keeps shingles of widespread
  lines and passages out of prefixes.
* Prefixes are a twentieth of the set longer than one common shingle needs, so
  that two sets that link share at least a twentieth of the larger one's shingles
  within both prefixes.  A group with fewer shared shingles than that has no
  partner at all; texts that merely hold the same passage end here.
* For every shared prefix shingle, the groups that hold it form a list, whose
  pivot is the group that shares the largest part of its prefix (the original of
  edited copies, as a rule).  Only (group, pivot) pairs are made at first, never
  all pairs of a list, so large groups of near copies cost a star each.
* Round 1 verifies each group's node against the group's first, and each group
  against the pivot it shares most with; round 2 the other pivots of groups that
  are still apart; round 3 what is left: in lists that still hold more than one
  component, groups are paired over their rarest shared shingles only (all but
  the twentieth they must share anyway), by size and by a bound on the overlap
  from the shared prefix shingles.  Copies that are not similar enough share
  hundreds of shingles; such a pair is made where its groups meet first, not again
  at the shingles that follow.  Verifying reads whole texts;
  candidates of one hub are dealt over as many tasks as they need.

Hashes have 64 bits (128 for the identity of sets); a text's words are those of
``[^\\x20\\x09-\\x0D]+``.  Defined results: with fewer than five words the whole
sequence is one shingle; null or empty text has no shingle and links with nothing;
a null id is no component's smallest unless alone; repeated rows are equal sets;
an empty table gives no rows; other columns are kept, and columns added here
replace their namesakes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cartwise.llm import windows as win
from cartwise.llm.common import table, written
from cartwise.llm.graph import components
from cartwise.llm.substrings import word_units

WORDS = 5
HUB_MEMBERS = 400     # texts verified against one hub in one group
SAMPLE_DOCS, SAMPLE_SHARE = 4000, 0.001
SEEN_GROUPS = 200_000  # groups a map task remembers having emitted
BEFORE = 8            # shingles before its own that a row of the last round's index knows


def lower_units(texts: list, gram: int, chunk: int) -> Iterator[win.Units]:
    """Word units of texts with A-Z lowered (``bytes.lower`` knows ASCII only)."""
    return word_units(WORDS)([(r, bytes(t).lower()) for r, t in texts], gram, chunk)


KIND = win.Windows(WORDS, WORDS, lower_units, 1.0)


def shingles(texts: list) -> list[np.ndarray]:
    """Shingle hashes (with repeats) of every text."""
    found: list[list] = [[] for _ in texts]
    rows = list(enumerate(texts))
    for units in lower_units(rows, WORDS, win.CHUNK_BYTES):
        for row, a, b in zip(units.rows.tolist(), units.first[:-1].tolist(), units.first[1:].tolist()):
            if b - a >= WORDS:
                found[row].append(units.grams[a:b - WORDS + 1])
    none = np.zeros(0, dtype=np.uint64)
    out = []
    for row, text in rows:
        if found[row]:
            out.append(found[row][0] if len(found[row]) == 1 else np.concatenate(found[row]))
            continue
        words = bytes(text).lower().split()
        if not words:
            out.append(none)
            continue
        h = np.uint64(len(words))  # fewer than five words: one shingle of its own kind
        for byte in b" ".join(words):
            h = win.mix64(np.array([h], dtype=np.uint64) ^ win._BYTE[byte])[0]
        out.append(np.array([h], dtype=np.uint64))
    return out


def required(n: int) -> int:
    """Shingles of the prefix of a set of ``n``: n - ceil(0.75 n) + 1 and a
    twentieth of the set more."""
    return n - (3 * n + 3) // 4 + 1 + n // 20


def _prefix(n: str):
    """The same as a column."""
    return F.col(n) - F.floor((3 * F.col(n) + 3) / 4) + 1 + F.floor(F.col(n) / 20)


def _least(n: str):
    """Prefix shingles that a set of ``n`` shares with any set it links with: the
    sets share ceil(0.75 m) at least, m being the larger size, and all but
    m - prefix(m) of them lie in both prefixes."""
    return F.greatest(F.lit(1), F.floor(F.col(n) / 20))


def _needed(a: str, b: str):
    """Prefix shingles that linked sets of these sizes share: of the 3/7 (a + b)
    they share at least, all but those beyond one of the prefixes."""
    beyond = F.greatest(F.col(a) - _prefix(a), F.col(b) - _prefix(b))
    return F.greatest(F.lit(1), F.ceil(3 * (F.col(a) + F.col(b)) / 7) - beyond)


def _signed(keys: np.ndarray) -> np.ndarray:
    """Unsigned order as signed longs."""
    return (keys ^ np.uint64(1 << 63)).view(np.int64)


def _sums(keys: np.ndarray) -> tuple[int, int]:
    one = win.mix64(keys)
    two = win.mix64(keys ^ np.uint64(0xA5A5A5A55A5A5A5A))
    return int(np.add.reduce(one)), int(np.add.reduce(two))


def _sets(batch: pa.RecordBatch, frequent: win.Frequent) -> Iterator[np.ndarray]:
    """Sorted distinct keys of each row, a bounded amount of text at a time."""
    group, room = [], 0
    texts = win._texts(batch)
    for i, (_, text) in enumerate(texts):
        group.append(text)
        room += len(text)
        if room >= win.CHUNK_BYTES or i == len(texts) - 1:
            for h in shingles(group):
                yield np.unique(frequent.order(h)) if len(h) else h
            group, room = [], 0


def _group_key(prefix: np.ndarray, n: int) -> int:
    value = (_sums(prefix)[0] + n * 0x9E3779B97F4A7C15) & (1 << 64) - 1
    return value - (1 << 64) if value >> 63 else value


SETS = "id long, tag int, n int, k string, g long, last long"


def summaries(frequent: win.Frequent):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = batch.schema.names
            n, k, g, last = [], [], [], []
            for keys in _sets(batch, frequent):
                size = len(keys)
                n.append(size)
                if not size:
                    k.append(None), g.append(None), last.append(None)
                    continue
                a, b = _sums(keys)
                prefix = keys[:required(size)]
                k.append(f"{a:016x}{b:016x}")
                g.append(_group_key(prefix, size))
                last.append(int(_signed(prefix[-1:])[0]))
            yield pa.RecordBatch.from_arrays(
                [batch.column(names.index(win.ID)), batch.column(names.index(win.TAG)),
                 pa.array(n, pa.int32()), pa.array(k, pa.string()), pa.array(g, pa.int64()),
                 pa.array(last, pa.int64())], names=["id", "tag", "n", "k", "g", "last"])

    return run


def prefixes(frequent: win.Frequent):
    """(token, g): the prefix of every group, once per group and task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            tokens, groups, counts, room = [], [], [], 0
            for keys in _sets(batch, frequent):
                if not len(keys):
                    continue
                prefix = keys[:required(len(keys))]
                g = _group_key(prefix, len(keys))
                if g in seen:
                    continue
                if len(seen) >= SEEN_GROUPS:
                    seen.clear()
                seen.add(g)
                tokens.append(prefix)
                groups.append(g)
                counts.append(len(prefix))
                room += len(prefix)
                if room > 200_000:
                    yield _token_rows(tokens, groups, counts)
                    tokens, groups, counts, room = [], [], [], 0
            if tokens:
                yield _token_rows(tokens, groups, counts)

    return run


def _token_rows(tokens: list, groups: list, counts: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(_signed(np.concatenate(tokens))),
         pa.array(np.repeat(np.array(groups, dtype=np.int64), counts))], names=["token", "g"])


def verifier(key, rows):
    """Links of one hub (the row without a member) with its members."""
    tool = zstandard.ZstdDecompressor()
    texts = [tool.decompress(t.as_py()) for t in rows.column("text")]
    members = rows.column("a").to_pylist()
    sets = [np.unique(s) for s in shingles(texts)]
    hub = next((sets[i] for i, a in enumerate(members) if a is None), None)
    found = []
    for a, own in zip(members, sets):
        if a is not None and hub is not None:
            both = len(np.intersect1d(own, hub, assume_unique=True))
            if 100 * both >= 75 * (len(own) + len(hub) - both):
                found.append(a)
    b = key[0].as_py()
    return pa.table([pa.array(found, pa.string()), pa.array([b] * len(found), pa.string())],
                    names=["a", "b"])


def salted(edges: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(a, b, salt) of the edges and (hub, salts): members of a hub b are dealt over
    salts.  ``edges`` is a written table, and so are the salts: the join has plain
    shuffles below it, and a hot hub's rows can be split."""
    counts = edges.groupBy("b").agg(F.count(F.lit(1)).alias("c"))
    salts = written(counts.select(F.col("b").alias("hub"),
                                  F.ceil(F.col("c") / HUB_MEMBERS).cast("int").alias("salts")),
                    "jaccard-salts")
    dealt = (edges.join(salts, edges["b"] == salts["hub"])
             .select("a", "b", F.pmod(F.xxhash64("a"), F.col("salts")).cast("int").alias("salt")))
    return dealt, salts


def verify(edges: DataFrame, texts: DataFrame) -> DataFrame:
    """The edges (a, b) that are links; each salt of a hub gets the hub's text."""
    dealt, salts = salted(edges)
    members = (dealt.join(texts, dealt["a"] == texts["k"]).select("b", "salt", "a", "text"))
    hubs = (salts.join(texts, salts["hub"] == texts["k"])
            .select(F.col("hub").alias("b"), F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"),
                    F.lit(None).cast("string").alias("a"), "text"))
    return (members.unionByName(hubs).groupBy("b", "salt")
            .applyInArrow(verifier, "a string, b string").select("a", "b"))


def _pressed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    tool = zstandard.ZstdCompressor(level=3)
    for batch in batches:
        bodies = [tool.compress(t.as_buffer()) for t in batch.column(2)]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(bodies, pa.binary())],
                                         names=["rid", "rtag", "text"])


def _texts_of(keyed: DataFrame, nodes: DataFrame) -> DataFrame:
    """(k, text) of the given nodes (k, id, tag), written once; texts are
    compressed before they move.  Sorted sides are merged whatever their sizes, so
    that the plan is the same for few and for many nodes."""
    nodes = written(nodes.select("k", "id", "tag").distinct(), "jaccard-need")
    rows = (keyed.select(win.ID, win.TAG, win.TEXT)
            .mapInArrow(_pressed, "rid long, rtag int, text binary"))
    joined = (rows.join(nodes.hint("merge"), (F.col("rid") == F.col("id")) & (F.col("rtag") == F.col("tag")))
              .select("k", "text").dropDuplicates(["k"]))
    return written(joined, "jaccard-texts")


def _size_fits(a: str, b: str):
    return 4 * F.least(a, b) >= 3 * F.greatest(a, b)


def linked(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with n_shingles and component_id."""
    own = [c for c in docs.columns if c not in ("n_shingles", "component_id")]
    keyed = win.keyed(docs.select(*own), id_col, text_col)
    narrow = keyed.select(win.ID, win.TAG, win.TEXT)
    frequent = win.Frequent(win.frequent_grams(narrow, KIND, SAMPLE_DOCS, SAMPLE_SHARE))
    sets = written(narrow.mapInArrow(summaries(frequent), SETS), "jaccard-sets")
    nodes = written(sets.where("n > 0").groupBy("k", "g", "n", "last")
                    .agg(F.min(F.struct("id", "tag")).alias("rep"))
                    .select("k", "g", "n", "last", "rep.id", "rep.tag"), "jaccard-nodes")
    groups = written(nodes.groupBy("g", "n", "last")
                     .agg(F.min("k").alias("lead"), F.count(F.lit(1)).alias("size")),
                     "jaccard-groups")
    lists = _lists(narrow.mapInArrow(prefixes(frequent), "token long, g long"), groups)
    one = groups.select(F.col("g"), F.col("n").alias("n1"), F.col("lead").alias("lead1"))
    two = groups.select(F.col("g").alias("pivot"), F.col("n").alias("n2"), F.col("lead").alias("lead2"))
    stars = written(lists.where("g != pivot").groupBy("g", "pivot").agg(F.count(F.lit(1)).alias("c")),
                    "jaccard-stars")
    # a near copy shares many prefix shingles with some pivot: begin with those
    strong = written(stars.where("c > 1").join(one, "g").join(two, "pivot")
                     .where(_size_fits("n1", "n2") & (F.col("c") * 50 >= F.col("n1")))
                     .select("g", "c", "lead1", "lead2"), "jaccard-strong")
    inner = (nodes.join(groups.where("size > 1").select("g", "lead"), "g").where("k != lead")
             .select(F.col("k").alias("a"), F.col("lead").alias("b")))
    best = (strong.groupBy("g").agg(F.max(F.struct("c", "lead1", "lead2")).alias("m"))
            .select(F.col("m.lead1").alias("a"), F.col("m.lead2").alias("b")))
    first = written(inner.unionByName(best), "jaccard-edges")
    rest = strong.select(F.col("lead1").alias("a"), F.col("lead2").alias("b"))
    wanted = first.unionByName(rest)
    need = (wanted.select(F.col("a").alias("k")).unionByName(wanted.select(F.col("b").alias("k")))
            .distinct().join(nodes, "k"))
    texts = _texts_of(keyed, need)
    links = written(verify(first, texts), "jaccard-links")
    roots = components(links)
    apart = _apart(rest, roots).join(first, ["a", "b"], "left_anti")
    links = written(links.unionByName(verify(written(apart, "jaccard-edges"), texts)),
                    "jaccard-links")
    roots = components(links)
    pairs = written(_residual(lists, stars, nodes, groups, roots), "jaccard-edges")
    if not pairs.isEmpty():
        need = (pairs.select(F.col("a").alias("k")).unionByName(pairs.select(F.col("b").alias("k")))
                .distinct().join(nodes, "k"))
        links = links.unionByName(verify(pairs, _texts_of(keyed, need)))
        roots = components(links)
    return _labelled(keyed, sets, nodes, roots, own, id_col)


def _lists(tokens: DataFrame, groups: DataFrame) -> DataFrame:
    """(token, g, pivot) of shingles that at least two groups hold, of groups that
    share enough of them to link with any."""
    order = Window.partitionBy("token").orderBy("g")
    running = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = tokens.select("token", "g", F.first("g").over(running).alias("low"),
                         F.lag("g").over(order).alias("before"), F.lead("g").over(order).alias("after"))
    # tasks may repeat a group: its first row, or the last one of the first group
    member = (F.col("g") != F.col("low")) & (F.col("before") != F.col("g"))
    lowest = (F.col("g") == F.col("low")) & (F.col("after") != F.col("g"))
    shared = written(rows.where(member | lowest).select("token", "g"), "jaccard-shared")
    able = (shared.groupBy("g").agg(F.count(F.lit(1)).alias("m")).join(groups.select("g", "n"), "g")
            .where(F.col("m") >= _least("n")).select("g", (F.col("m") / _prefix("n")).alias("rate")))
    best = Window.partitionBy("token").orderBy(F.col("rate").desc(), "g")
    running = best.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = shared.join(able, "g").select(
        "token", "g", F.first("g").over(running).alias("pivot"), F.lead("g").over(best).alias("after"))
    return written(ranked.where((F.col("g") != F.col("pivot")) | F.col("after").isNotNull())
                   .select("token", "g", "pivot"), "jaccard-lists")


def _with_root(df: DataFrame, column: str, roots: DataFrame, name: str) -> DataFrame:
    r = roots.select(F.col("v").alias("__v"), F.col("r").alias("__r"))
    return (df.join(r, df[column] == r["__v"], "left")
            .withColumn(name, F.coalesce("__r", column)).drop("__v", "__r"))


def _apart(edges: DataFrame, roots: DataFrame) -> DataFrame:
    """Edges between different components."""
    both = _with_root(_with_root(edges.distinct(), "a", roots, "ra"), "b", roots, "rb")
    return both.where("ra != rb").select("a", "b")


def _may_link(shared):
    """Whether sets 1 and 2 that share at most so many prefix shingles may link."""
    # beyond the prefix that ends first nothing is counted: its set's rest may all be shared
    beyond = F.when(F.col("last1") <= F.col("last2"), F.col("n1") - _prefix("n1")).otherwise(
        F.col("n2") - _prefix("n2"))
    return (shared >= _needed("n1", "n2")) & (7 * (shared + beyond) >= 3 * (F.col("n1") + F.col("n2")))


def _met(index: DataFrame) -> DataFrame:
    """Pairs of groups that may link, made at the first shingle both rows hold and
    hardly again: groups that also share one of the shingles just before have met there,
    with more of theirs left.  The first is never left out, so no pair is lost."""
    columns = ("g", "n", "last", "lo", "hi", "left", "before")
    x = index.select("token", *[F.col(c).alias(c + "1") for c in columns])
    y = index.select("token", *[F.col(c).alias(c + "2") for c in columns])
    apart = F.expr("lo1 != lo2 OR hi1 != hi2 OR lo1 != hi1")
    return (x.join(y, "token")
            .where((F.col("g1") < F.col("g2")) & apart & _size_fits("n1", "n2")
                   & _may_link(F.least("left1", "left2")) & ~F.arrays_overlap("before1", "before2"))
            .select("g1", "g2", "n1", "n2", "last1", "last2"))


def _residual(lists: DataFrame, stars: DataFrame, nodes: DataFrame, groups: DataFrame,
              roots: DataFrame) -> DataFrame:
    """Pairs of nodes of different components that may still link."""
    rooted = written(_with_root(nodes.select("k", "g"), "k", roots, "root"), "jaccard-rooted")
    spans = written(rooted.groupBy("g").agg(F.min("root").alias("lo"), F.max("root").alias("hi")),
                    "jaccard-spans")
    one = spans.select("g", "lo", "hi")
    two = spans.select(F.col("g").alias("pivot"), F.col("lo").alias("lo2"), F.col("hi").alias("hi2"))
    # lists in which some group is not wholly in the pivot's component
    open_ = written(stars.join(one, "g").join(two, "pivot")
                    .where("lo != hi OR lo2 != hi2 OR lo != lo2").select("g", "pivot"), "jaccard-open")
    tokens = lists.join(open_, ["g", "pivot"], "left_semi").select("token").distinct()
    rows = written(lists.join(tokens, "token", "left_semi").select("token", "g"), "jaccard-open-lists")
    # what a group shares with others of another component lies in these lists
    able = (rows.groupBy("g").agg(F.count(F.lit(1)).alias("m")).join(groups.select("g", "n", "last"), "g")
            .where(F.col("m") >= _least("n")))
    counts = rows.join(able.select("g"), "g", "left_semi").groupBy("token").agg(F.count(F.lit(1)).alias("len"))
    rare = Window.partitionBy("g").orderBy("len", "token")  # at most a prefix of rows
    index = (rows.join(counts.where("len > 1"), "token").join(able, "g").join(one, "g")
             .withColumn("at", F.row_number().over(rare))
             .withColumn("before", F.collect_list("token").over(rare.rowsBetween(-BEFORE, -1)))
             .where(F.col("at") <= F.col("m") - _least("n") + 1))
    # from a shingle on, so many of the group's open shingles are left
    index = written(index.select("token", "g", "n", "last", "lo", "hi", "before",
                                 (F.col("m") - F.col("at") + 1).alias("left")), "jaccard-index")
    pairs = _met(index).distinct()
    held = rows.join(index.select("g").distinct(), "g", "left_semi").groupBy("g").agg(
        F.collect_list("token").alias("t"))  # at most a prefix
    held = written(held, "jaccard-held")
    pairs = (pairs.join(held.select(F.col("g").alias("g1"), F.col("t").alias("t1")), "g1")
             .join(held.select(F.col("g").alias("g2"), F.col("t").alias("t2")), "g2"))
    shared = F.size(F.array_intersect("t1", "t2"))
    pairs = pairs.where(_may_link(shared)).select("g1", "g2")
    m1 = rooted.select(F.col("k").alias("a"), F.col("g").alias("g1"), F.col("root").alias("ra"))
    m2 = rooted.select(F.col("k").alias("b"), F.col("g").alias("g2"), F.col("root").alias("rb"))
    across = pairs.join(m1, "g1").join(m2, "g2").where("ra != rb").select("a", "b")
    split = spans.where("lo != hi").select("g")
    p = rooted.join(split, "g", "left_semi")
    within = (p.select("g", F.col("k").alias("a"), F.col("root").alias("ra"))
              .join(p.select("g", F.col("k").alias("b"), F.col("root").alias("rb")), "g")
              .where("a < b AND ra != rb").select("a", "b"))
    return across.unionByName(within).distinct()


def component_ids(rooted: DataFrame) -> DataFrame:
    """(kk, component_id) of nodes (k, id, root).  The components' ids are written, so
    that the rows of a large component can be split in the join."""
    smallest = written(rooted.groupBy("root").agg(F.min("id").alias("component_id")), "jaccard-smallest")
    return rooted.join(smallest, "root").select(F.col("k").alias("kk"), "component_id")


def _labelled(keyed: DataFrame, sets: DataFrame, nodes: DataFrame, roots: DataFrame,
              own: list[str], id_col: str) -> DataFrame:
    # a null id stands as the smallest number in keys; it is no component's id
    real = F.when(F.col("id") == win.MIN_ID, F.lit(None)).otherwise(F.col("id"))
    ids = sets.where("n > 0").groupBy("k").agg(F.min(real).alias("id"))
    rooted = written(_with_root(ids, "k", roots, "root"), "jaccard-labels")
    of_node = component_ids(rooted)
    rows = (sets.select("id", "tag", "n", "k").distinct()
            .join(of_node, F.col("k") == F.col("kk"), "left")
            .select(F.col("id").alias("__jid"), F.col("tag").alias("__jtag"),
                    F.col("n").cast("long").alias("n_shingles"), "component_id"))
    return (keyed.join(rows, (keyed[win.ID] == rows["__jid"]) & (keyed[win.TAG] == rows["__jtag"]),
                       "left")
            .select(*own, F.coalesce("n_shingles", F.lit(0)).cast("long").alias("n_shingles"),
                    F.coalesce("component_id", F.col(id_col).cast("long")).alias("component_id")))


def deduplicated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One document of each component, the one of the smallest id (with its
    repeated rows); documents without shingles, or without an id, all stay."""
    rows = linked(docs, id_col, text_col)
    kept = rows.where((F.col("n_shingles") == 0) | F.col(id_col).eqNullSafe(F.col("component_id"))
                      | F.col("component_id").isNull())
    return kept.select(*docs.columns)


def op8_jaccard(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return linked(docs).select("doc_id", "n_shingles", "component_id")


OP8_SQL = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, COALESCE(regexp_extract_all(
           translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x20\x09-\x0D]+'), []) AS ws FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(
        CASE WHEN len(ws) >= 5
             THEN list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' '))
             WHEN len(ws) > 0 THEN [array_to_string(ws, ' ')] ELSE [] END) AS sh FROM d),
n AS (SELECT doc_id, COUNT(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS x, b.doc_id AS y, COUNT(*) AS c
      FROM s a JOIN s b ON a.sh = b.sh AND a.doc_id < b.doc_id GROUP BY a.doc_id, b.doc_id),
l AS (SELECT x, y FROM p JOIN n nx ON nx.doc_id = x JOIN n ny ON ny.doc_id = y
      WHERE 100 * c >= 75 * (nx.n + ny.n - c)),
b AS (SELECT x, y FROM l UNION SELECT y, x FROM l),
r AS (SELECT x, y FROM b UNION SELECT r.x, b.y FROM r JOIN b ON r.y = b.x),
m AS (SELECT x, MIN(y) AS low FROM r GROUP BY x)
SELECT d.doc_id, CAST(COALESCE(n.n, 0) AS BIGINT) AS n_shingles,
       CAST(LEAST(d.doc_id, COALESCE(m.low, d.doc_id)) AS BIGINT) AS component_id
FROM d LEFT JOIN n ON n.doc_id = d.doc_id LEFT JOIN m ON m.x = d.doc_id
"""
