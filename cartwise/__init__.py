"""cartwise: next-basket reorder analytics on Spark.

Builds (user, product) candidate pairs from order history, labels them
against each user's newest order, derives eighteen behavioural features,
splits by user, scales, trains Spark ML classifiers and evaluates them with
threshold-based F1 metrics.  Every step is a lazy DataFrame transformation;
the driver only ever sees tiny results (metrics, model parameters).
"""

from cartwise.schema import FEATURES, ID_COL, ITEM_COL, LABEL_COL  # noqa: F401

__all__ = ["FEATURES", "ID_COL", "ITEM_COL", "LABEL_COL"]
