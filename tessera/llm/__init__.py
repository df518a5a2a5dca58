"""Operators for large-scale training-data pipelines.

Nothing else in the library imports this subpackage. Each module holds one
operator with its own general interface; ``queries`` registers one query per
operator and ``corpus_pipeline.py`` chains four of them.
"""
