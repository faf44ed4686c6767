"""feedloom: data-pipeline operators for batch tables and Structured Streaming.

Every operator is a function from DataFrames to a DataFrame.  Reading and
writing live in :mod:`feedloom.sources` and :mod:`feedloom.sinks`, so the same
operator runs over ``spark.read`` and ``spark.readStream``.
"""

__version__ = "0.1.0"
