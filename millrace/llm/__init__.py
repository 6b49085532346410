"""Operators for preparing training data; nothing outside this folder and corpus_pipeline.py imports it."""
