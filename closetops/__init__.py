"""closetops: rental-commerce analytics as Spark DataFrame plans.

Layout
------
sources/    table catalogue, calendar dimension, bindings of the driver tables
functions/  column-level helpers (boundary date differences, zone shifts, predicates)
operators/  reusable relational building blocks (sequence logs, range joins,
            horizon counts, cumulative sums)
plans/      one module per report; each function takes DataFrames plus explicit
            parameters and returns a lazy DataFrame
oracle/     independent DuckDB SQL used to check every plan
"""

__all__ = ["session"]
