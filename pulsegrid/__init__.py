"""Telemetry analytics on Spark DataFrames.

Subpackages: ``sources`` (readers, writers, test inputs), ``functions`` (column
expressions), ``operators`` (DataFrame -> DataFrame operators), ``plans`` (the
batch jobs and the dashboard query set) and ``streaming`` (Structured Streaming
forms). ``catalog.QUERIES`` lists every registered query.
"""

__version__ = "0.1.0"
