"""Group-aware train/test split and K folds.

Groups (users) are ordered by a seeded md5 key, which plays the role of a
random permutation and is reproducible in any engine:

* test  = the ``int(n * test_size)`` first groups;
* fold  = ``(rank - 1) * k div n``: k contiguous, near-equal slices of the
  permutation (uneven counts allowed).

A side or fold is a range of that order, so it is decided by comparing a row's
own (key, group) with the last group of the range.  Finding those boundary groups
(one for a split, k - 1 for k folds) is a job over the distinct groups; the rows
themselves are only filtered, never shuffled.

The rank of a group is computed without a single-partition sort: groups are
bucketed by the first four hex digits of the key (65,536 buckets, uniform by
construction), ranked inside their bucket, and offset by the number of groups
in earlier buckets (a running count over at most 65,536 rows).

All rows of a group always land on the same side / in the same fold.  A null
group belongs to no range: it is in the training side and in no fold.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cartwise.functions.expr import group_rank_key

_BUCKET_HEX = 4  # 16**4 buckets


def group_ranks(df: DataFrame, group_col: str, seed: int | None) -> DataFrame:
    """group_col, rank (1..n), n for every distinct group of ``df``."""
    groups = (df.select(group_col).distinct()
              .withColumn("_key", group_rank_key(group_col, seed))
              .withColumn("_bucket",
                          F.conv(F.substring("_key", 1, _BUCKET_HEX), 16, 10).cast("int")))
    hist = groups.groupBy("_bucket").agg(F.count(F.lit(1)).alias("_cnt"))
    # at most 16**4 rows: a window without partitioning is bounded here
    whole = Window.orderBy("_bucket")
    hist = hist.select(
        "_bucket",
        F.coalesce(F.sum("_cnt").over(whole.rowsBetween(Window.unboundedPreceding, -1)),
                   F.lit(0)).alias("_before"),
        F.sum("_cnt").over(whole.rowsBetween(Window.unboundedPreceding,
                                             Window.unboundedFollowing)).alias("n"),
    )
    in_bucket = Window.partitionBy("_bucket").orderBy("_key", group_col)
    ranked = groups.withColumn("_rin", F.row_number().over(in_bucket))
    return (ranked.join(F.broadcast(hist), "_bucket")
            .select(group_col, (F.col("_before") + F.col("_rin")).alias("rank"), "n"))


def boundaries(df: DataFrame, group_col: str, seed: int | None, wanted) -> list[tuple]:
    """(key, group) of the groups whose rank ``wanted(rank, n)`` selects, in
    order: a few rows, by the caller's choice of ranks."""
    r = group_ranks(df.where(F.col(group_col).isNotNull()), group_col, seed)
    key = group_rank_key(group_col, seed).alias("_key")
    rows = r.where(wanted(F.col("rank"), F.col("n"))).select(key, group_col, "rank").collect()
    return [(x["_key"], x[group_col]) for x in sorted(rows, key=lambda x: x["rank"])]


def _up_to(group_col: str, seed: int | None, boundary: tuple) -> Column:
    """Is the row's group at or before the boundary group?"""
    key = group_rank_key(group_col, seed)
    return (key < F.lit(boundary[0])) | ((key == F.lit(boundary[0]))
                                         & (F.col(group_col) <= F.lit(boundary[1])))


def in_test(df: DataFrame, group_col: str = "user_id", test_size: float = 0.1,
            seed: int | None = 29) -> Column:
    """A condition on rows of ``df``: is the group among the test groups?"""
    last = boundaries(df, group_col, seed,
                      lambda rank, n: rank == F.floor(n * F.lit(float(test_size))))
    if not last:
        return F.lit(False)
    return F.coalesce(_up_to(group_col, seed, last[0]), F.lit(False))


def with_split(df: DataFrame, group_col: str = "user_id", test_size: float = 0.1,
               seed: int | None = 29) -> DataFrame:
    """``df`` + ``split`` ('train' / 'test')."""
    test = in_test(df, group_col, test_size, seed)
    return df.withColumn("split", F.when(test, F.lit("test")).otherwise(F.lit("train")))


def train_test_by_group(df: DataFrame, group_col: str = "user_id", test_size: float = 0.1,
                        seed: int | None = 29) -> tuple[DataFrame, DataFrame]:
    """(train, test): no group appears on both sides."""
    test = in_test(df, group_col, test_size, seed)
    return df.where(~test), df.where(test)


def group_folds(df: DataFrame, group_col: str = "user_id", num_folds: int = 5,
                seed: int | None = None) -> DataFrame:
    """group_col, fold (0..num_folds-1)."""
    r = group_ranks(df, group_col, seed)
    fold = F.expr(f"(rank - 1) * {int(num_folds)} div n").cast("int")
    return r.select(group_col, fold.alias("fold"))


def with_folds(df: DataFrame, group_col: str = "user_id", num_folds: int = 5,
               seed: int | None = None) -> DataFrame:
    """Rows of ``df`` with a group, and their ``fold``."""
    rows = df.where(F.col(group_col).isNotNull())
    r = group_ranks(rows, group_col, seed)
    fold = F.expr(f"(rank - 1) * {int(num_folds)} div n").cast("int")
    last_of_fold = (F.expr(f"rank * {int(num_folds)} div n") != fold) | (F.col("rank") == F.col("n"))
    ends = r.where(last_of_fold).select(group_rank_key(group_col, seed).alias("_key"), group_col,
                                        "rank", fold.alias("fold")).collect()  # one row per fold
    case = F.when(F.lit(False), F.lit(0))
    for x in sorted(ends, key=lambda x: x["rank"]):
        case = case.when(_up_to(group_col, seed, (x["_key"], x[group_col])), F.lit(x["fold"]))
    return rows.withColumn("fold", case.cast("int"))
