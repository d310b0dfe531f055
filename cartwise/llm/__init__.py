"""Operators of a training-data pipeline over documents, pages and embeddings.

Nothing else in the library imports this subpackage.  ``registry`` holds the
queries that apply each operator to its whole table.
"""
