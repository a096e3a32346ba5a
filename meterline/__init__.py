"""meterline: trip-record cleaning and analytics on Spark DataFrames.

Layout
------
functions/  column expressions (parsing, rounding, JSON, display formats, geometry)
sources/    readers (CSV, JSON polygons) and test fixtures derived from the given tables
operators/  normalise, dedup, features, anomaly rules, error log, joins, aggregates, sorting, sinks
plans/      the load pipeline and the named analytics queries
streaming/  Structured Streaming ingest
"""

__version__ = "0.1.0"
