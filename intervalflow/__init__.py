"""intervalflow: interval time-series analytics on Spark DataFrames.

Sub-packages
------------
functions   Column expressions (time normalisation, codes, identity stamps).
sources     Readers for landed JSON documents, pages and the Parquet lake.
sinks       Partitioned, idempotent Parquet writers.
operators   Joins, de-duplication, quality checks, roll-ups, tariffs, heating.
streaming   Incremental loads, high-water state, backfills, late data.
plans       Bindings of the driver tables onto the domain and the named queries.
"""

__version__ = "0.1.0"
