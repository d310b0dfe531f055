"""Spark ML models: logistic regression and gradient-boosted trees on the
feature matrix, importances, group cross-validation."""

from cartwise.models.train import (  # noqa: F401
    feature_importance,
    fit_gbt,
    fit_logistic_regression,
    gbt_estimator,
    logistic_regression_estimator,
    positive_probability,
)
