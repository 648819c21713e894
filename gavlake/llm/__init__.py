"""Operators for preparing training text, each built by its own method.

Nothing outside this subpackage (and ``corpus_pipeline.py``) imports it.
"""
