"""Spark-native analytics over I/Q signal tables, and operators for training corpora."""
