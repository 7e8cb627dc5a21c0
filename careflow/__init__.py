"""Spark-native warehouse for healthcare change logs: dimensions, facts and windowed summaries."""
