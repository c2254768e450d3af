"""PySpark-native credit-risk analytics: loading, features, scoring, mart, metrics, monitoring."""
