"""livemart: a live e-commerce analytics engine written as Spark DataFrame plans.

Every operator is a function from DataFrame(s) to a DataFrame built only from
built-in Spark SQL expressions, so Catalyst can push filters into the Parquet
scan, prune columns, combine aggregates map-side and pick the join strategy.
The same operator functions run on batch tables and on streaming DataFrames;
``livemart.streaming`` adds watermarks, triggers and idempotent sinks.
"""

__version__ = "0.1.0"
