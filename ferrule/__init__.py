"""Spark-native feature, validation and scoring operators."""
