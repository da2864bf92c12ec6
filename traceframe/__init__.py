"""Trace, feature, document and prediction tables as Spark DataFrame operators."""

__version__ = "0.1.0"
