"""Operators for large-scale training-data preparation.

Each module holds one operator; ``registry`` lists their queries.  Nothing
outside this subpackage imports it.
"""
