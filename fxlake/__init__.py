"""Spark-native foreign-exchange journal engine."""

__version__ = "0.1.0"
