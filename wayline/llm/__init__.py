"""Operators for training-data pipelines: formatting, archives, dedup, language, scoring, mixing."""
