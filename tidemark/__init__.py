"""tidemark: keyed time-series medallion analytics on Spark DataFrames.

Layers:
  sources/    readers and sinks (JSON snapshots, Parquet tables)
  functions/  Column builders (hash, time parsing, pct change, classification)
  operators/  DataFrame -> DataFrame operators (reshape, ingest, series, movers,
              profile, forecast, context)
  plans/      silver / gold / pipeline jobs and the driver query catalog
  streaming/  Structured Streaming ingestion
"""

__version__ = "0.1.0"
