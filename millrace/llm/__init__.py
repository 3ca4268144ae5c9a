"""Operators of a training-data pipeline over whole text corpora.

Nothing else in the library imports this subpackage; it can be removed.
"""
