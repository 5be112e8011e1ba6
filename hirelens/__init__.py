"""hirelens: job-postings analytics on Spark.

Layers:
  functions/  Column -> Column expressions (text extraction, cleaning), JVM-only
  operators/  DataFrame -> DataFrame (gold tables, reports, merges, ML)
  sources/    readers / writers / catalog, and the driver-table adapter
  plans/      registered report queries and their SQL oracles
  streaming/  incremental ingest as an availableNow Structured Streaming query
"""

__version__ = "0.1.0"
