"""Rank metrics of scored rows: AUC and log loss by group.

AUC by mid-ranks: the sum over positives of the negatives with a lower score, equal
ones counting half, over all pairs.  Rows are combined by (group, distinct score)
before the shuffle; a running count of negatives over a group's distinct scores needs
no sort of a whole group: scores are cut into equal-width ranges, the counts of a
group's ranges (a few thousand numbers) give each range its offset, and the windows
run inside one range.  Log loss is a sum over the same counts.

A null score ranks below all others, NaN above; both count as the probability at
that end.  A group without positives or without negatives has a null AUC.  Rows with
a null label take no part.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

RANGES = 4096
CLIP = 1e-15  # probabilities closer to 0 or 1 than this count as this


def _counts(scored: DataFrame, score_col: str, label: str, groups: list[str]) -> DataFrame:
    """groups, _s, _pos, _neg for every distinct score of a group."""
    score = F.coalesce(F.col(score_col).cast("double"), F.lit(float("-inf")))
    rows = scored.where(F.col(label).isNotNull())
    # -0.0 and 0.0 are one group for Spark's aggregation, as NaNs are
    return rows.groupBy(*groups, score.alias("_s")).agg(
        F.sum(F.when(F.col(label) == 1, 1).otherwise(0)).cast("double").alias("_pos"),
        F.sum(F.when(F.col(label) == 1, 0).otherwise(1)).cast("double").alias("_neg"))


def _range(low: float, high: float, ranges: int):
    """Number of the equal-width range of a score between ``low`` and ``high``."""
    s = F.col("_s")
    inside = F.floor((s - F.lit(low)) / F.lit((high - low) / ranges))
    return (F.when(F.isnan(s) | (s >= high), ranges).when(s < low, -1)
            .otherwise(F.least(inside, F.lit(ranges - 1)))).cast("int")


def rank_metrics(scored: DataFrame, score_col: str = "score", label: str = "in_cart",
                 groups: list[str] | None = None, low: float = 0.0, high: float = 1.0,
                 ranges: int = RANGES) -> DataFrame:
    """groups, n_rows, n_positive, auc, log_loss.  Scores are expected between ``low``
    and ``high`` (others are right too, but share two ranges); the log loss takes
    them as probabilities."""
    groups = groups or []
    cells = _counts(scored, score_col, label, groups).withColumn("_b", _range(low, high, ranges))
    totals = cells.groupBy(*groups, "_b").agg(F.sum("_neg").alias("_in"))
    before = Window.partitionBy(*groups).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(*[F.col(g).alias("_g" + str(i)) for i, g in enumerate(groups)],
                            F.col("_b").alias("_ob"),
                            F.coalesce(F.sum("_in").over(before), F.lit(0.0)).alias("_offset"))
    same = F.col("_b") == F.col("_ob")
    for i, g in enumerate(groups):
        same = same & F.col(g).eqNullSafe(F.col("_g" + str(i)))
    inside = (Window.partitionBy(*groups, "_b").orderBy("_s")
              .rowsBetween(Window.unboundedPreceding, -1))
    ranked = cells.join(offsets, same).withColumn(
        "_below", F.col("_offset") + F.coalesce(F.sum("_neg").over(inside), F.lit(0.0)))
    p = F.when(F.isnan("_s"), F.lit(1.0)).otherwise(F.col("_s"))
    p = F.least(F.greatest(p, F.lit(CLIP)), F.lit(1.0 - CLIP))
    sums = ranked.groupBy(*groups).agg(
        F.sum("_pos").alias("_p"), F.sum("_neg").alias("_n"),
        F.sum(F.col("_pos") * (F.col("_below") + F.col("_neg") / 2)).alias("_won"),
        F.sum(-F.col("_pos") * F.log(p) - F.col("_neg") * F.log1p(-p)).alias("_loss"))
    return sums.select(*groups, (F.col("_p") + F.col("_n")).cast("long").alias("n_rows"),
                       F.col("_p").cast("long").alias("n_positive"),
                       F.try_divide("_won", F.col("_p") * F.col("_n")).alias("auc"),
                       F.try_divide(F.col("_loss"), F.col("_p") + F.col("_n")).alias("log_loss"))


def auc_by_group(counts: DataFrame, groups: list[str]) -> DataFrame:
    """groups, auc, from counts (groups, _s, _pos, _neg) of few distinct scores, which
    may hold a score several times: one shuffle of the counts, then a window over a
    group's distinct scores."""
    cells = counts.groupBy(*groups, "_s").agg(
        F.sum("_pos").cast("double").alias("_pos"), F.sum("_neg").cast("double").alias("_neg"))
    below = Window.partitionBy(*groups).orderBy("_s").rowsBetween(Window.unboundedPreceding, -1)
    ranked = cells.withColumn("_below", F.coalesce(F.sum("_neg").over(below), F.lit(0.0)))
    won = F.sum(F.col("_pos") * (F.col("_below") + F.col("_neg") / 2))
    return ranked.groupBy(*groups).agg(
        F.try_divide(won, F.sum("_pos") * F.sum("_neg")).alias("auc"))
