"""Column expressions (JVM-side, codegen-friendly; no Python UDFs)."""

from cartwise.functions.expr import (  # noqa: F401
    apply_threshold,
    cart_percentile_sum,
    f1_from_counts,
    group_rank_key,
    histogram_bin,
    hour_of_week,
    ratio,
    threshold_bucket,
)
