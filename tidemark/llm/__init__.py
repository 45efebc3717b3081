"""Operators of a training-data pipeline over document tables.

One module per operator; ``queries`` registers one query per operator and the
DuckDB oracles of those SQL can express. Nothing outside this subpackage
imports it.
"""
