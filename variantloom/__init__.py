"""Spark-native analytics for annotated, multi-sample genomic variant extracts."""

__version__ = "0.1.0"
