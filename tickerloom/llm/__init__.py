"""Operators for training-data pipelines: scoring, filtering, de-duplication, archives and token files."""
