"""Operators of a training-data pipeline over text, pages and embeddings.

Nothing outside this package imports it. Each module holds one operator with a general DataFrame interface;
``queries.py`` holds the thin registered queries.
"""
