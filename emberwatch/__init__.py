"""Spark-native analytics for industrial sensor-risk data."""
