"""Operators of a training-data pipeline over documents, pages and conversations.

Nothing else in the package imports this subpackage.  Every operator is a
function over DataFrames; the thin registered queries live in ``queries.py``.
"""
