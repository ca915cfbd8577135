"""Operators for training-data pipelines over a documents table.

Each module holds one operator with a general interface; :mod:`queries`
registers one query per operator. Nothing outside this subpackage (and
``corpus_pipeline.py``) imports it.
"""
