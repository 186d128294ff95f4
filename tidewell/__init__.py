"""Spark operators for table ingestion, change capture, history and reconciliation.

Everything is a function from DataFrames to DataFrames (or a streaming query);
Catalyst plans the work and AQE adapts it.  Sub-packages:

``functions``  column-level helpers: type names, row hashes, time arithmetic
``sources``    table, file and stream readers
``operators``  transforms, change capture, SCD history, merge, dedup, skew tools
``plans``      larger compositions: reconciliation, key discovery, usage reports
``sinks``      writers, folders
``streaming``  file ingest and change application as streaming queries
"""

__version__ = "0.1.0"
