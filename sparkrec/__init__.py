"""sparkrec: user-item interaction logs to graded ratings, ALS models,
hold-out evaluation, grids and ranked top-k lists, as Spark DataFrame jobs.

Layout
------
sources/    schemas, CSV / Parquet readers and writers, table stand-ins
functions/  column expressions (rating rule, split hash, error terms)
operators/  DataFrame -> DataFrame operators (ratings, split, model,
            evaluation, grid, top-k)
plans/      session / workspace helpers, join strategy and the three jobs
"""

__version__ = "0.1.0"
