"""Operators of a training-data pipeline over a ``documents`` table.

Nothing outside this subpackage imports it; it can be removed as a whole.
"""
