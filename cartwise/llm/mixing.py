"""Mixing sources to target weights by capped water-filling.

Every source gets a share of the mix in proportion to its weight, but no more
than ``max_epochs`` times its own size; what a clamped source cannot take is
shared anew among the others by weight until none is above its cap.  Sorted by
cap/weight the clamped sources are a prefix, so one pass of running sums finds
the common level (words per unit of weight) and no iteration is needed.

A target of 1.4 epochs means every document once, and a seeded sample of
documents holding 0.4 of the source's words once more.  The sample is a prefix
of the source in the order of a seeded digest of the id; the document at the
boundary is taken in part, so a source's words meet its rounded target exactly.

Scale: the documents are aggregated by (source, digest prefix) before any
shuffle; running sums go over the 4096 prefixes of a source, and inside one
prefix only, so a source that holds a third of all rows is spread over 4096
keys.  Only DataFrame functions are used.

Defined results: null or empty text has size 0 and takes 0; a null source is a
source of its own, sorted last; a null id is digested as the word ``null``;
repeated rows are separate documents (equal ones are interchangeable); an empty
table gives no rows; other columns are kept untouched, and the columns this
operator adds replace columns of the same name.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cartwise.llm.common import WORD, word_count

P = "__mix_"
PREFIX = 3  # hex digits: 4096 digest prefixes


def source_targets(sizes: DataFrame, weights: Sequence[float], share: float,
                   max_epochs: float) -> DataFrame:
    """(source, source_size) -> source, source_size, target.

    Weights repeat over the sources in code-point order, null last.  The frame
    has one row per source; its running sums are over sources, not documents.
    """
    w = F.array(*[F.lit(x) for x in weights])
    order = Window.orderBy(F.col("source").asc_nulls_last())
    rows = (sizes.withColumn("_n", F.row_number().over(order))
            .withColumn("_w", F.element_at(w, ((F.col("_n") - 1) % len(weights) + 1).cast("int")))
            .withColumn("_cap", F.col("source_size") * F.lit(max_epochs))
            .withColumn("_r", F.col("_cap") / F.col("_w")))
    everything = Window.partitionBy()
    rising = Window.orderBy("_r", "_n").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = (rows
            .withColumn("_total", F.sum("source_size").over(everything) * F.lit(float(share)))
            .withColumn("_left", F.col("_total") - (F.sum("_cap").over(rising) - F.col("_cap")))
            .withColumn("_open", F.sum("_w").over(everything)
                        - (F.sum("_w").over(rising) - F.col("_w")))
            .withColumn("_level", F.col("_left") / F.col("_open"))
            .withColumn("_pos", F.row_number().over(Window.orderBy("_r", "_n"))))
    # the first source, by cap/weight, that the level does not lift above its cap
    first = F.min(F.when(F.col("_level") <= F.col("_r"),
                         F.struct("_pos", "_level"))).over(everything)
    rows = rows.withColumn("_first", first)
    below = F.col("_first").isNull() | (F.col("_pos") < F.col("_first._pos"))
    target = F.when(below, F.col("_cap")).otherwise(
        F.least(F.col("_cap"), F.col("_first._level") * F.col("_w")))
    return rows.select("source", "source_size", target.cast("double").alias("target"))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        source_col: str = "source", weights: Sequence[int] = (5, 2, 1), share: float = 1.5,
        max_epochs: int = 2, seed: int = 7) -> DataFrame:
    """``docs`` with size, source_size, target, taken (words, repeats counted),
    and epochs/part: whole repetitions and the words of a last partial one."""
    added = ["size", "source_size", "target", "taken", "epochs", "part"]
    own = [c for c in docs.columns if c not in added]
    digest = F.md5(F.concat(F.lit(f"{seed}:"),
                            F.coalesce(F.col(id_col).cast("string"), F.lit("null"))))
    keyed = docs.select(*own, F.col(source_col).alias(P + "source"),
                        F.col(id_col).alias(P + "id"),
                        digest.alias(P + "u"),
                        F.substring(digest, 1, PREFIX).alias(P + "b"),
                        word_count(F.col(text_col)).alias(P + "size"))
    cells = keyed.groupBy(F.col(P + "source").alias("source"),
                          F.col(P + "b").alias("b")).agg(F.sum(P + "size").alias("cell"))
    targets = source_targets(cells.groupBy("source").agg(F.sum("cell").alias("source_size")),
                             weights, share, max_epochs)
    targets = targets.withColumn("want", F.floor(F.col("target") + 0.5).cast("long"))
    size = F.col("source_size")
    targets = (targets
               .withColumn("epochs", F.when(size > 0, F.floor(F.col("want") / size))
                           .otherwise(F.lit(0)).cast("long"))
               .withColumn("rest", F.col("want") - F.col("epochs") * size)
               .withColumnRenamed("source", "s"))
    run = (Window.partitionBy("source").orderBy("b")
           .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    cells = cells.withColumn("before", F.sum("cell").over(run) - F.col("cell"))
    cells = (cells.join(targets, F.col("source").eqNullSafe(F.col("s")))
             .select(*[F.col(c).alias(P + "c_" + c) for c in
                       ("source", "b", "before", "source_size", "target", "epochs", "rest")]))
    joined = keyed.join(cells, F.col(P + "source").eqNullSafe(F.col(P + "c_source"))
                        & (F.col(P + "b") == F.col(P + "c_b")))
    inside = (Window.partitionBy(P + "source", P + "b").orderBy(P + "u", P + "id", P + "size")
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    before = F.col(P + "c_before") + F.sum(P + "size").over(inside) - F.col(P + "size")
    part = F.least(F.col(P + "size"),
                   F.greatest(F.lit(0).cast("long"), F.col(P + "c_rest") - F.col(P + "before")))
    return (joined.withColumn(P + "before", before).withColumn(P + "part", part)
            .select(*own, F.col(P + "size").alias("size"),
                    F.col(P + "c_source_size").alias("source_size"),
                    F.col(P + "c_target").alias("target"),
                    (F.col(P + "c_epochs") * F.col(P + "size") + F.col(P + "part")).alias("taken"),
                    F.col(P + "c_epochs").alias("epochs"), F.col(P + "part").alias("part")))


def mixture(docs: DataFrame, text_col: str = "text", length_col: str = "n_chars",
            **options) -> DataFrame:
    """The mix itself: every document once per whole repetition, and once more
    (cut after ``part`` words, if it is the boundary document) for the rest.
    Same columns as ``docs``; documents that the mix takes nothing of go."""
    mixed = mix(docs, text_col=text_col, **options)
    name = P + "copy"
    times = F.col("epochs") + F.when(F.col("part") > 0, 1).otherwise(0)
    whole = F.when(F.col("size") > 0, times).otherwise(F.lit(0).cast("long"))
    rows = mixed.withColumn(name, F.explode(F.when(whole > 0, F.sequence(F.lit(1).cast("long"), whole))
                                            .otherwise(F.array().cast("array<bigint>"))))
    cut = (F.col(name) > F.col("epochs")) & (F.col("part") < F.col("size"))
    words = F.slice(F.regexp_extract_all(F.col(text_col), F.lit(WORD), F.lit(0)),
                    F.lit(1), F.greatest(F.lit(1), F.col("part").cast("int")))
    text = F.when(cut, F.array_join(words, " ")).otherwise(F.col(text_col))
    out = rows.select(*[F.col(c) for c in docs.columns if c != text_col], text.alias(text_col),
                      cut.alias(P + "cut"))
    if length_col in docs.columns:
        length = F.when(F.col(P + "cut"), F.char_length(text_col)).otherwise(F.col(length_col))
        out = out.withColumn(length_col, length.cast(docs.schema[length_col].dataType))
    return out.select(*docs.columns)


def op7_mixing(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "source")
    return mix(docs).select("doc_id", "size", "source_size", "target", "taken")


OP7_SQL = r"""
WITH d AS (
  SELECT doc_id, source,
         CAST(COALESCE(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size,
         md5('7:' || COALESCE(CAST(doc_id AS VARCHAR), 'null')) AS u
  FROM documents),
s AS (SELECT source, CAST(SUM(size) AS BIGINT) AS source_size FROM d GROUP BY source),
n AS (SELECT *, row_number() OVER (ORDER BY source NULLS LAST) AS rk FROM s),
w AS (SELECT *, CASE (rk - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS w,
             2 * source_size AS cap FROM n),
r AS (SELECT *, CAST(cap AS DOUBLE) / w AS r FROM w),
l AS (SELECT *, row_number() OVER (ORDER BY r, rk) AS pos,
       (CAST(SUM(source_size) OVER () AS DOUBLE) * 1.5
        - CAST(SUM(cap) OVER (ORDER BY r, rk ROWS UNBOUNDED PRECEDING) - cap AS DOUBLE))
       / CAST(SUM(w) OVER () - (SUM(w) OVER (ORDER BY r, rk ROWS UNBOUNDED PRECEDING) - w)
              AS DOUBLE) AS level
      FROM r),
f AS (SELECT MIN(pos) AS fpos, arg_min(level, pos) AS flevel FROM l WHERE level <= r),
t AS (SELECT source, source_size,
             CASE WHEN fpos IS NULL OR pos < fpos THEN CAST(cap AS DOUBLE)
                  ELSE LEAST(CAST(cap AS DOUBLE), flevel * w) END AS target
      FROM l LEFT JOIN f ON TRUE),
q AS (SELECT *, CAST(floor(target + 0.5) AS BIGINT) AS want FROM t),
e AS (SELECT *, CASE WHEN source_size > 0 THEN want // source_size ELSE 0 END AS epochs FROM q),
c AS (SELECT d.doc_id, d.size, e.source_size, e.target, e.epochs,
             e.want - e.epochs * e.source_size AS rest,
             SUM(d.size) OVER (PARTITION BY d.source ORDER BY d.u, d.doc_id, d.size
                               ROWS UNBOUNDED PRECEDING) - d.size AS before
      FROM d JOIN e ON d.source IS NOT DISTINCT FROM e.source)
SELECT doc_id, size, source_size, target,
       CAST(epochs * size + LEAST(size, GREATEST(0, rest - before)) AS BIGINT) AS taken
FROM c
"""
