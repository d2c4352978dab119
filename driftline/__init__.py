"""Spark-native trajectory engine and training-data operators."""
