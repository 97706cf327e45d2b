"""Operators for training-data pipelines: one module each, with its query (and SQL) at its end."""
