"""Operators for training-data pipelines over text tables."""
