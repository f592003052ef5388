"""Operators for training-data pipelines on tables of texts; nothing else in the package imports them."""
