"""Meter-telemetry analytics on PySpark.

Sub-packages: ``functions`` (Column expressions), ``sources`` (scans, sinks,
table maintenance), ``operators`` (DataFrame -> DataFrame), ``plans``
(multi-step flows: medallion, contracts), ``streaming`` (Structured Streaming
jobs) and ``registry`` (the queries the check tool runs, with their SQL).
"""
