"""Spark-native building blocks for batch and incremental warehouse loading."""
