"""Spark-native engine for time-ordered bars, indicators and signals."""
