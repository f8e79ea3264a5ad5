"""Spark-native conversation distillation: flatten, redact, pack, validate, merge, curate and report."""

__version__ = "0.1.0"
