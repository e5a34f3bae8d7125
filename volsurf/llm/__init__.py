"""Operators for large training-data pipelines.

Nothing outside this subpackage imports it.  Each module holds one operator
with its own general interface; ``queries`` holds the thin registered queries.
"""
