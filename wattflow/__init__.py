"""wattflow: building-energy analytics on Spark DataFrames and Structured Streaming.

Every public operator is a function over ``pyspark.sql.DataFrame`` (bounded or
unbounded). The session is always passed in; nothing here owns global paths.
"""

__version__ = "0.1.0"
