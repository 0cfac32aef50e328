"""gridcast: hourly time-series analytics on Spark.

Ingest, resample and join demand/weather/calendar feeds, derive the
`train` and `serve` feature profiles, validate frames, cut sequences,
forecast, correct bias and score -- for many series at once, expressed
with DataFrame / SQL / Spark ML / Structured Streaming operators.
"""

__all__ = ["session", "functions", "operators", "sources", "plans", "streaming"]
