"""Service-request analytics on Spark: cleaning, features, folds, models and error reports."""
