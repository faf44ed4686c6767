"""Operators of a training-data pipeline: one module per operator, plus its queries.

Nothing else in the library imports this package.
"""
