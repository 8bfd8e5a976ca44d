"""Operators and queries for training-data pipelines over document tables."""
