"""Spark-native analytics for collaborative map notes."""
