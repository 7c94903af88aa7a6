"""corpusloom: instruction-data preparation and evaluation analytics on Spark DataFrames.

Every operator takes and returns DataFrames (or Columns). Row-level work is
built-in expressions and array higher-order functions; selection, dedup and
metrics are windows, aggregates and TakeOrdered thresholds planned by Catalyst.
"""

__version__ = "0.1.0"
