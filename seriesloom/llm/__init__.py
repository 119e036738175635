"""Operators for preparing language-model training data.

Each module holds one operator with a general interface; ``queries`` holds the
thin registered queries.  Nothing outside this package imports it.
"""
