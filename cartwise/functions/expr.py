"""Scalar column expressions used across the engine."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def ratio(num, den) -> Column:
    """num / den as double; null when den is 0 (ANSI mode would raise)."""
    return F.try_divide(_c(num).cast("double"), _c(den).cast("double"))


def hour_of_week(dow, hour) -> Column:
    """Hour of the week, 0..167: day-of-week * 24 + hour."""
    return _c(dow) * 24 + _c(hour)


def cart_percentile_sum(mult, sumpos, cart) -> Column:
    """Sum over ``mult`` lines of ``1 - (pos - 1) / cart`` given the sum of
    their positions: mult - (sumpos - mult) / cart (linear in pos)."""
    mult, sumpos, cart = _c(mult), _c(sumpos), _c(cart)
    return mult.cast("double") - (sumpos - mult).cast("double") / cart.cast("double")


def apply_threshold(proba, threshold: float) -> Column:
    """0/1 prediction; a probability equal to the threshold is positive, a null
    one is negative, NaN counts as above every threshold."""
    return F.coalesce(_c(proba) >= F.lit(float(threshold)), F.lit(False)).cast("int")


def f1_from_counts(tp, fp, fn) -> Column:
    """F1 of the positive class, 2tp / (2tp + fp + fn); 0 when undefined."""
    tp, fp, fn = _c(tp), _c(fp), _c(fn)
    den = 2 * tp + fp + fn
    return F.when(den == 0, F.lit(0.0)).otherwise((2 * tp).cast("double") / den.cast("double"))


def histogram_bin(x, bins: int = 19) -> Column:
    """Bin index of ``x`` among ``bins`` equal-width bins on [0, 1]; the last
    bin is closed on the right.  Edges are ``k * (1 / bins)`` and the floor
    estimate is corrected against them."""
    x = _c(x)
    width = 1.0 / bins
    k0 = F.floor(x * bins).cast("int")
    lower = k0.cast("double") * F.lit(width)
    upper = (k0 + 1).cast("double") * F.lit(width)
    k = (F.when(x < lower, k0 - 1)
         .when((x >= upper) & (k0 < bins - 1), k0 + 1)
         .otherwise(k0))
    return F.least(F.greatest(k, F.lit(0)), F.lit(bins - 1))


def threshold_bucket(p, steps: int = 100) -> Column:
    """Largest k in 0..steps with ``p >= k / steps`` (compared as doubles,
    exactly as a threshold test would), so that ``p >= t_j  <=>  k >= j``; null is
    -1 (below every threshold) and NaN ``steps`` (above)."""
    p = _c(p)
    k0 = F.floor(p * steps).cast("int")
    hi = (k0 + 1).cast("double") / F.lit(float(steps))
    lo = k0.cast("double") / F.lit(float(steps))
    k = F.when(p >= hi, k0 + 1).when(p < lo, k0 - 1).otherwise(k0)
    inside = F.least(F.greatest(k, F.lit(-1)), F.lit(steps))
    return F.when(p.isNull(), F.lit(-1)).when(F.isnan(p), F.lit(steps)).otherwise(inside)


def group_rank_key(group, seed: int | None) -> Column:
    """Deterministic pseudo-random sort key for a group value: the md5 hex of
    ``"<seed>:<group>"``; identical in any engine with md5.  ``None`` is a seed
    like any other (one fixed permutation), so that plans stay repeatable; draw a
    seed for a different permutation each time."""
    s = "" if seed is None else str(seed)
    return F.md5(F.concat(F.lit(s + ":"), _c(group).cast("string")))
