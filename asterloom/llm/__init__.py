"""Operators for training-data pipelines: one module each, over DataFrames of documents."""
