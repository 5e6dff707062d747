"""Operators of a training-data pipeline, and the queries that apply them.

Nothing outside this folder imports it; ``catalog`` lists the queries.
"""
