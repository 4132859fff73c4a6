"""candlewick: market-tick analytics expressed as Spark DataFrame and
Structured Streaming operators.

Sub-packages
------------
sources    readers that turn tables, files or streams into tick / sample DataFrames
functions  column-level helpers (parsing, validation, latencies, formatting)
operators  DataFrame -> DataFrame operators (candles, alerts, series math, ...)
plans      the registered queries and the metric catalogue
streaming  streaming jobs, foreachBatch sinks and the progress listener
"""

from candlewick.session import get_session, prepare, checkpoint_root

__all__ = ["get_session", "prepare", "checkpoint_root"]
