"""Marketplace analytics on Spark: sources, cleaning functions, operators and layered models."""

__version__ = "0.1.0"
