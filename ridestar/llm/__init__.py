"""Operators of a training-data pipeline over text and vectors, one module per operator.

Nothing outside this package imports it; its queries are in ``queries``.
"""
