"""Operators for training-data pipelines over the corpus tables; nothing outside this folder imports them."""
