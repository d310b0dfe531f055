"""End-to-end jobs: build (features -> split -> scale -> models) and
evaluate (thresholds, F1 overall and per user, importances)."""
