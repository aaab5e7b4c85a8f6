"""tripwise: weekly travel-log ETL and analysis marts expressed as Spark jobs.

Layers (see README):
  sources/    scans, sinks, typed loads
  operators/  DataFrame -> DataFrame cleansing, slicing, consolidation, profiling
  functions/  Column expressions (address parsing, dates, code labels)
  plans/      processed tables, the 14 analysis marts, run modes
  streaming/  insert-only change capture with file streams + checkpoints
"""

__all__ = ["session", "schemas"]
