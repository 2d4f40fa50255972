"""Operators of a training-data pipeline: coding, dedup, scoring, mixing.

Nothing outside this package imports it. Every operator takes DataFrames and
returns DataFrames; ``queries.py`` derives the registered queries from them.
"""
