"""Spark-native record linkage and the measurements around it."""
