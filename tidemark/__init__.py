"""tidemark: point-in-time cohorts, labels, features, scoring and evaluation on Spark."""
