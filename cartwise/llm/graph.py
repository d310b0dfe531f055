"""Connected components of an edge table by contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwise.llm.common import written


def _roots(parents: DataFrame) -> DataFrame:
    """(v, r) with every parent replaced by its tree's root, by pointer jumping.
    Parents are smaller than their children, so the pointers form a forest."""
    now = written(parents, "graph-roots")
    while True:
        up = now.select(F.col("v").alias("u"), F.col("r").alias("s"))
        nxt = written(now.join(up, now["r"] == up["u"], "left")
                      .select("v", F.coalesce("s", "r").alias("r"), (F.col("s") != F.col("r")).alias("moved")),
                      "graph-roots")
        now = nxt.select("v", "r")
        if nxt.where("moved").isEmpty():
            return now


def components(edges: DataFrame) -> DataFrame:
    """(a, b) -> (v, r): the smallest vertex of the component of each vertex.

    Each round points every vertex at its smallest neighbour, follows the
    pointers to their roots and contracts the edges; vertices at least halve.
    All state is in written tables; nothing but emptiness reaches the driver.
    """
    labels = None
    now = written(edges.select("a", "b").where("a != b").distinct(), "graph-edges")
    while not now.isEmpty():
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        parents = (both.groupBy(F.col("a").alias("v")).agg(F.min("b").alias("r"))
                   .select("v", F.least("v", "r").alias("r")))
        roots = _roots(parents)
        if labels is None:
            labels = roots
        else:
            up = roots.select(F.col("v").alias("u"), F.col("r").alias("s"))
            labels = written(labels.join(up, labels["r"] == up["u"], "left")
                             .select("v", F.coalesce("s", "r").alias("r")), "graph-labels")
        one = roots.select(F.col("v").alias("a"), F.col("r").alias("ra"))
        two = roots.select(F.col("v").alias("b"), F.col("r").alias("rb"))
        now = written(now.join(one, "a").join(two, "b").where("ra != rb")
                      .select(F.col("ra").alias("a"), F.col("rb").alias("b")).distinct(),
                      "graph-edges")
    if labels is None:
        return edges.select(F.col("a").alias("v"), F.col("b").alias("r")).limit(0)
    return labels
