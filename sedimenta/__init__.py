"""Spark-native snapshot analytics: strict typing, audits, diffs, episodes and panels."""

__version__ = "0.1.0"
