"""Recommendation lists from scored candidates."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def recommend_for_user(scores: DataFrame, products: DataFrame, user_id: int | None = None,
                       score_col: str = "score") -> DataFrame:
    """One user's products with score and product attributes, best first.

    Without ``user_id`` the user with the most scored products is chosen
    (ties: lowest id), decided inside the plan.
    """
    if user_id is None:
        who = (scores.groupBy("user_id").agg(F.count(F.lit(1)).alias("_n"))
               .orderBy(F.desc("_n"), "user_id").limit(1).select("user_id"))
        mine = scores.join(who, "user_id", "left_semi")
    else:
        mine = scores.where(F.col("user_id") == F.lit(user_id))
    extra = [c for c in products.columns if c not in ("user_id", "product_id", score_col)]
    return (mine.join(products.select("product_id", *extra), "product_id", "left")
            .select("user_id", "product_id", *extra, score_col)
            .orderBy(F.desc(score_col), "product_id"))


def recommend_topk(scores: DataFrame, k: int = 5, score_col: str = "score",
                   products: DataFrame | None = None) -> DataFrame:
    """Top-k products per user (rank 1 = highest score; ties: lower id), with the
    attributes of ``products`` if given.  A user's window holds only that user's
    candidates (bounded by the catalogue size); attributes join the few rows kept."""
    w = Window.partitionBy("user_id").orderBy(F.desc(score_col), "product_id")
    top = (scores.withColumn("rank", F.row_number().over(w).cast("int"))
           .where(F.col("rank") <= k)
           .select("user_id", "rank", "product_id", score_col))
    if products is None:
        return top
    extra = [c for c in products.columns if c not in top.columns]
    return (top.join(products.select("product_id", *extra), "product_id", "left")
            .select("user_id", "rank", "product_id", *extra, score_col))
