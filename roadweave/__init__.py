"""Spark-native road-network sensor fusion."""
