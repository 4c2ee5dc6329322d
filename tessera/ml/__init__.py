"""Models: splits, feature recipes, Spark ML estimators, tuning, metrics and diagnostics."""
