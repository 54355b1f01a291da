"""snapvault: whole-table snapshots of relational sources as Parquet, on Spark.

Modules:
  functions  scalar column functions (decode, hex, sizes, names, snapshot ids)
  sources    Parquet / JDBC sources and the catalog DataFrames
  operators  filters, projections, catalog joins, row numbering, validation
  plans      chunk planning and the export jobs
  sinks      Parquet writers and table entries
  streaming  file-arrival and failure-event streams, retention tiers
"""

__version__ = "0.1.0"
