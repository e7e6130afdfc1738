"""Operators for a training-data pipeline: tokens, secrets, joins, classifiers, mixing, packing.

Each module holds one operator; ``queries.py`` registers the catalogue queries and
``oracle.py`` their SQL. Nothing outside this folder imports it.
"""
