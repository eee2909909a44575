"""Operators for preparing training data from a table of documents.

Nothing outside this folder (and ``corpus_pipeline.py``) imports it.
"""
