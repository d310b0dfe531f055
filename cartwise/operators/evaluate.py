"""Threshold-based evaluation of scored candidates.

Input: a frame with ``user_id``, a 0/1 label and a probability/score column.
A score that is null predicts 0 at every threshold, a NaN score 1 (Spark orders it
above all numbers), here and in the sweep alike.

Everything is an aggregation: the overall confusion counts are one global
aggregate, per-user F1 one ``groupBy(user_id)`` (map-side combined), the
threshold sweep one ``groupBy`` over score buckets followed by running sums
over at most ``steps + 1`` rows (no cross join of rows with thresholds), and the
sweep of the mean per-user F1 the same over changes of the users' F1.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cartwise.functions.expr import apply_threshold, f1_from_counts, histogram_bin, \
    threshold_bucket


def with_prediction(scores: DataFrame, threshold: float, score_col: str = "score",
                    out: str = "prediction") -> DataFrame:
    return scores.withColumn(out, apply_threshold(score_col, threshold))


def _counts(label: str, pred: str):
    y, p = F.col(label), F.col(pred)
    return [
        F.sum(F.when((p == 1) & (y == 1), 1).otherwise(0)).cast("long").alias("tp"),
        F.sum(F.when((p == 1) & (y == 0), 1).otherwise(0)).cast("long").alias("fp"),
        F.sum(F.when((p == 0) & (y == 1), 1).otherwise(0)).cast("long").alias("fn"),
        F.sum(F.when((p == 0) & (y == 0), 1).otherwise(0)).cast("long").alias("tn"),
    ]


def _safe(num, den):
    return F.when(den == 0, F.lit(0.0)).otherwise(num.cast("double") / den.cast("double"))


def overall_metrics(scores: DataFrame, threshold: float = 0.5, score_col: str = "score",
                    label: str = "in_cart") -> DataFrame:
    """One row: threshold, tp, fp, fn, tn, precision, recall, f1 (class 1)."""
    pred = with_prediction(scores, threshold, score_col, "_pred")
    c = pred.agg(*_counts(label, "_pred"))
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    return c.select(
        F.lit(float(threshold)).alias("threshold"), "tp", "fp", "fn", "tn",
        _safe(tp, tp + fp).alias("precision"),
        _safe(tp, tp + fn).alias("recall"),
        f1_from_counts(tp, fp, fn).alias("f1"),
    )


def threshold_sweep(scores: DataFrame, steps: int = 100, score_col: str = "score",
                    label: str = "in_cart") -> DataFrame:
    """threshold (k / steps for k = 0..steps), tp, fp, fn, f1.

    One aggregation into score buckets (at most steps + 2 rows), then
    running sums over that small grid; the grid includes bucket -1 (scores
    below 0) so the total positive count comes from the same window instead
    of a second pass over the scores.
    """
    spark = scores.sparkSession
    buckets = scores.groupBy(threshold_bucket(score_col, steps).alias("k")).agg(
        F.sum(F.col(label).cast("long")).alias("pos"),
        F.count(F.lit(1)).alias("cnt"),
    )
    grid = spark.range(-1, steps + 1).select(F.col("id").cast("int").alias("k"))
    g = grid.join(F.broadcast(buckets), "k", "left")
    # running sums from the top over steps + 2 rows (bounded)
    top = Window.orderBy(F.desc("k")).rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.orderBy("k").rowsBetween(Window.unboundedPreceding,
                                           Window.unboundedFollowing)
    g = g.select(
        "k",
        F.coalesce(F.sum("pos").over(top), F.lit(0)).alias("tp"),
        F.coalesce(F.sum("cnt").over(top), F.lit(0)).alias("pp"),
        F.coalesce(F.sum("pos").over(whole), F.lit(0)).alias("positives"),
    ).where(F.col("k") >= 0)
    tp = F.col("tp").cast("long")
    fp = (F.col("pp") - F.col("tp")).cast("long")
    fn = (F.col("positives") - F.col("tp")).cast("long")
    return g.select(
        (F.col("k").cast("double") / F.lit(float(steps))).alias("threshold"),
        tp.alias("tp"), fp.alias("fp"), fn.alias("fn"),
        f1_from_counts(tp, fp, fn).alias("f1"),
    )


def best_threshold(sweep: DataFrame) -> DataFrame:
    """The threshold with the highest F1 (ties: the lower threshold)."""
    return sweep.orderBy(F.desc("f1"), "threshold").limit(1)


def per_user_f1(scores: DataFrame, threshold: float = 0.5, score_col: str = "score",
                label: str = "in_cart", group_col: str = "user_id") -> DataFrame:
    """group_col, tp, fp, fn, f1 (0 when a user has no actual and no
    predicted positives)."""
    pred = with_prediction(scores, threshold, score_col, "_pred")
    c = pred.groupBy(group_col).agg(*_counts(label, "_pred")[:3])
    return c.select(group_col, "tp", "fp", "fn", f1_from_counts("tp", "fp", "fn").alias("f1"))


def user_threshold_sweep(scores: DataFrame, steps: int = 100, score_col: str = "score",
                         label: str = "in_cart", group_col: str = "user_id") -> DataFrame:
    """threshold (k / steps for k = 0..steps), n_users, mean_f1: the mean of the
    users' F1 at every threshold.

    A user's F1 changes only at the user's own score buckets.  Rows are combined
    by (user, bucket) before the shuffle; a window over at most steps + 2 rows per
    user turns them into changes of F1, which are summed by bucket; running sums
    from the top over that small grid are the sweep.  No row meets a threshold.
    """
    spark = scores.sparkSession
    cells = scores.groupBy(group_col, threshold_bucket(score_col, steps).alias("_k")).agg(
        F.sum(F.col(label).cast("long")).alias("_pos"), F.count(F.lit(1)).alias("_cnt"))
    mine = Window.partitionBy(group_col)
    falling = mine.orderBy(F.desc("_k"))
    above = falling.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    tp, pp = F.sum("_pos").over(above), F.sum("_cnt").over(above)
    f1 = f1_from_counts(tp, pp - tp, F.sum("_pos").over(mine) - tp)
    changes = cells.select(group_col, "_k", f1.alias("_f1")).select(
        "_k", (F.col("_f1") - F.coalesce(F.lag("_f1").over(falling), F.lit(0.0))).alias("_change"),
        F.when(F.lag("_k").over(falling).isNull(), 1).otherwise(0).alias("_first"))
    buckets = changes.groupBy(F.col("_k").alias("k")).agg(
        F.sum("_change").alias("change"), F.sum("_first").alias("users"))
    grid = spark.range(-1, steps + 1).select(F.col("id").cast("int").alias("k"))
    g = grid.join(F.broadcast(buckets), "k", "left")  # steps + 2 rows
    top = Window.orderBy(F.desc("k")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    whole = Window.orderBy("k").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    g = g.select("k", F.coalesce(F.sum("change").over(top), F.lit(0.0)).alias("f1"),
                 F.coalesce(F.sum("users").over(whole), F.lit(0)).cast("long").alias("n_users"))
    return g.where("k >= 0").select(
        (F.col("k").cast("double") / F.lit(float(steps))).alias("threshold"), "n_users",
        F.try_divide(F.col("f1"), F.col("n_users").cast("double")).alias("mean_f1"))


def best_user_threshold(sweep: DataFrame) -> DataFrame:
    """The threshold with the highest mean per-user F1.  Means that agree to nine
    decimals are ties (they are sums in no fixed order) and go to the lower one."""
    return sweep.orderBy(F.desc(F.round("mean_f1", 9)), "threshold").limit(1)


def mean_user_f1(per_user: DataFrame) -> DataFrame:
    return per_user.agg(F.count(F.lit(1)).alias("n_users"), F.avg("f1").alias("mean_f1"))


def f1_histogram(per_user: DataFrame, bins: int = 19, col: str = "f1") -> DataFrame:
    """bin, lower, upper, n_users over equal-width bins on [0, 1] (all bins,
    empty ones with 0)."""
    spark: SparkSession = per_user.sparkSession
    counts = per_user.groupBy(histogram_bin(col, bins).alias("bin")).agg(
        F.count(F.lit(1)).alias("n_users"))
    grid = spark.range(bins).select(F.col("id").cast("int").alias("bin"))
    width = 1.0 / bins
    return grid.join(F.broadcast(counts), "bin", "left").select(
        "bin",
        (F.col("bin").cast("double") * F.lit(width)).alias("lower"),
        ((F.col("bin") + 1).cast("double") * F.lit(width)).alias("upper"),
        F.coalesce(F.col("n_users"), F.lit(0)).cast("long").alias("n_users"),
    )


def users_with_f1(per_user: DataFrame, target: float = 0.8, limit: int | None = None,
                  group_col: str = "user_id") -> DataFrame:
    """The users whose F1 is ``target``, in order; all of them unless ``limit``
    asks for a first few."""
    found = (per_user.where(F.abs(F.col("f1") - F.lit(float(target))) < F.lit(1e-9))
             .select(group_col).orderBy(group_col))
    return found if limit is None else found.limit(limit)


def precision_from_counts(tp, fp, fn, tn):
    return _safe(tp, tp + fp)


def recall_from_counts(tp, fp, fn, tn):
    return _safe(tp, tp + fn)


def f1_metric(tp, fp, fn, tn):
    return f1_from_counts(tp, fp, fn)


def fold_scores(scored: DataFrame, threshold: float = 0.5, score_col: str = "score",
                label: str = "in_cart", fold_col: str = "fold", scorer=f1_metric,
                name: str = "f1") -> DataFrame:
    """fold, <name>: one score per fold from one aggregation.  ``scorer``
    maps the confusion-count columns (tp, fp, fn, tn) to a metric column."""
    pred = with_prediction(scored, threshold, score_col, "_pred")
    c = pred.groupBy(fold_col).agg(*_counts(label, "_pred"))
    tp, fp, fn, tn = (F.col(x) for x in ("tp", "fp", "fn", "tn"))
    return c.select(fold_col, scorer(tp, fp, fn, tn).alias(name))


def mean_fold_score(fold_scores_df: DataFrame, name: str = "f1") -> DataFrame:
    return fold_scores_df.agg(F.count(F.lit(1)).alias("n_folds"),
                              F.avg(name).alias(f"mean_{name}"))
