"""Operators for preparing language-model training data.

Nothing outside this subpackage imports it.  Each module is one operator with a
general interface; ``registry`` holds the queries that apply them to the tables.
"""
