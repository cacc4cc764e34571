"""Spark-native spatial instance analytics."""
