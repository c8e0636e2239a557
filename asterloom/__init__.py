"""Asterloom: raw nested records to an incrementally loaded star schema, on Spark."""

__version__ = "0.1.0"
