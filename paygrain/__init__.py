"""Spark-native analytics for incomplete administrative wage data."""
