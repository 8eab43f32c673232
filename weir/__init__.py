"""Spark-native building blocks for instruction and training data."""
