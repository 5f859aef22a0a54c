"""Operators of a training-data pipeline: near duplicates, quality, privacy, mixing, extraction.

Nothing outside this package (and ``corpus_pipeline.py``, which belongs to it) imports it.
"""
