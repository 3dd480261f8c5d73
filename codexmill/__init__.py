"""Codexmill: record reconciliation and text data processing on Spark."""

__version__ = "0.1.0"
