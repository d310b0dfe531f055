"""Min-max scaling fitted on one frame and applied to others.

Fit is one aggregation (a single row of minima and maxima, collected like
any estimator's fitted parameters); transform is a projection with literal
coefficients, so it stays inside whole-stage codegen.  Semantics follow the
usual definition (x - min) / (max - min); a constant column keeps a range
of 1, so its train values map to 0; values outside the training range are
not clipped.  Spark ML's MinMaxScaler maps a constant
column to 0.5 instead, hence this class.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_EPS = 2.220446049250313e-16  # double machine epsilon


@dataclass
class MinMaxModel:
    columns: list[str]
    mins: list[float]
    maxs: list[float]

    def ranges(self) -> list[tuple[float, float]]:
        """(min, range) per column; a (near-)zero range is replaced by 1."""
        out = []
        for lo, hi in zip(self.mins, self.maxs):
            lo = 0.0 if lo is None else lo
            rng = (hi - lo) if hi is not None else 0.0
            out.append((lo, 1.0 if abs(rng) < 10 * _EPS else rng))
        return out

    def transform(self, df: DataFrame) -> DataFrame:
        scaled = {c: ((F.col(c).cast("double") - F.lit(lo)) / F.lit(rng)).alias(c)
                  for c, (lo, rng) in zip(self.columns, self.ranges())}
        return df.select(*[scaled.get(c, F.col(c)) for c in df.columns])


def fit_min_max(df: DataFrame, columns: list[str]) -> MinMaxModel:
    aggs = []
    for c in columns:
        aggs += [F.min(F.col(c).cast("double")), F.max(F.col(c).cast("double"))]
    row = df.agg(*aggs).first()
    return MinMaxModel(list(columns), [row[2 * i] for i in range(len(columns))],
                       [row[2 * i + 1] for i in range(len(columns))])
