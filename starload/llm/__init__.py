"""Operators for training-data pipelines, each a function over DataFrames.

Every operator keeps a general interface in its own module; ``queries.py`` holds
the thin registered queries and ``oracle.py`` their DuckDB statements. Nothing
else in the library imports this subpackage.
"""
