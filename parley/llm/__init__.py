"""Operators of a training-data pipeline, and the queries op1 to op13 with their SQL.

Nothing else in the library imports this subpackage; it can be deleted.
"""
