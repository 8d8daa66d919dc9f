"""Spark-native analytics engine for multi-provider geo-temporal observations."""
