"""Operators of large-scale training-data pipelines."""
