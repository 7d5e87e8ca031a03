"""Operators and queries for large-scale training-data preparation.

Self-contained: nothing else in the library imports this subpackage. Each
operator module holds the general operator; ``queries.py`` holds the thin
``opN_*`` queries registered by ``__spark_entry__.py``.
"""
