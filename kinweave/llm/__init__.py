"""Operators for large training-data pipelines.

Nothing outside this folder imports it.  The queries are in ``queries.py``.
"""
