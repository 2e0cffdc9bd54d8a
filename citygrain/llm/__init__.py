"""Operators of a training-data pipeline, and the queries that apply them to the given tables.

Nothing else in this package imports this one.
"""
