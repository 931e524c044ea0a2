"""Spark-native forecast verification and data-quality engine."""
