"""Spark-native risk analytics over application records."""
