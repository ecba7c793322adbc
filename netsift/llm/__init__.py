"""Operators of a training-data pipeline: dedup, extraction, scoring, packing, tokens.

Nothing outside this subpackage imports it (only ``__spark_entry__.py`` and
``corpus_pipeline.py``, both guarded or removed with it).
"""
