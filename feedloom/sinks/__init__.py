"""Sinks.

A *batch writer* is a function of (DataFrame, batch id).  Running it again with
the same id leaves the same result, so it can serve ``foreachBatch`` and a
plain batch job alike.
"""
