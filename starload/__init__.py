"""starload: warehouse-load operators on Spark DataFrames.

Landed JSON payloads are flattened into batch-stamped staging tables, type-1
dimensions and a calendar dimension are maintained with surrogate keys,
insert-only facts are loaded with key resolution and duplicate guards, every
load batch is audited, and role-playing star joins and season summaries are
served from the result. Every operator is a function over DataFrames with the
table and column names passed in.
"""

__version__ = "0.1.0"
