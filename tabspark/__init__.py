"""Spark-native operators for keyed, time-ordered tables."""

__version__ = "0.1.0"
