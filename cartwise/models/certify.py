"""How far a fitted logistic regression can be from its optimum.

The penalised objective per row, mean(log loss) + w'w / (2 C n), is strongly convex in
the weights with modulus 1 / (C n) once the intercept is at its best; so a gradient g
bounds how much better any other model can be: |g|^2 C n / 2.  The gradient is one
aggregation over the rows, with the model as a column expression.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwise.models.expressions import linear_margin, logistic
from cartwise.models.train import LR_C
from cartwise.schema import FEATURES, LABEL_COL

INTERCEPT = "(intercept)"


def optimality_certificate(model: PipelineModel, train: DataFrame, features: list[str] = FEATURES,
                           label: str = LABEL_COL, c: float = LR_C) -> DataFrame:
    """feature, weight, gradient, gap: one row per feature and one for the intercept.
    ``gap`` (the same in all rows) bounds the objective above its minimum."""
    last = model.stages[-1]
    weights = dict(zip(features, last.coefficients.toArray().tolist()))
    error = logistic(linear_margin(last, features)) - F.col(label).cast("double")
    sums = train.agg(F.count(F.lit(1)).alias("n"), F.avg(error).alias("g_i"),
                     *[F.avg(error * F.col(f)).alias(f"g_{i}") for i, f in enumerate(features)])
    penalty = F.lit(1.0) / (F.lit(c) * F.col("n"))
    rows = [F.struct(F.lit(f).alias("feature"), F.lit(float(weights[f])).alias("weight"),
                     (F.col(f"g_{i}") + F.lit(float(weights[f])) * penalty).alias("gradient"))
            for i, f in enumerate(features)]
    rows.append(F.struct(F.lit(INTERCEPT).alias("feature"), F.lit(float(last.intercept)).alias("weight"),
                         F.col("g_i").alias("gradient")))
    found = sums.select(F.array(*rows).alias("rows"), penalty.alias("penalty"))
    square = F.aggregate("rows", F.lit(0.0), lambda a, r: a + r["gradient"] * r["gradient"])
    return (found.select(F.explode("rows").alias("r"), (square / (2 * F.col("penalty"))).alias("gap"))
            .select("r.feature", "r.weight", "r.gradient", "gap"))
