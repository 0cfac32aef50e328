"""Resampling and time spines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridcast.functions.calendar import dst_flags_day25, hour_floor


def resample_hourly(df: DataFrame, series=("series_id",), ts: str = "ts",
                    values: dict | None = None, dst: bool = True) -> DataFrame:
    """Sub-hourly readings -> hourly means per series (G1).

    Partial aggregation runs map-side; one shuffle on (series, hour).
    DST flags are a function of the hour, so they are derived after the
    aggregation (deterministic, unlike `first`).
    """
    values = values or {"load": "actual_demand"}
    series = list(series)
    out = df.groupBy(*series, hour_floor(ts).alias(ts)).agg(
        *[F.avg(src).alias(dst_name) for src, dst_name in values.items()])
    if dst:
        out = out.select("*", *dst_flags_day25(ts))
    return out


def hour_spine(spark: SparkSession, start, end, interval: str = "1 hour",
               col: str = "ts") -> DataFrame:
    """Timestamps from start (inclusive) to end (exclusive) by interval (B2)."""
    start, end = F.lit(start).cast("timestamp_ntz"), F.lit(end).cast("timestamp_ntz")
    iv = F.expr(f"INTERVAL {interval}")
    return spark.range(1).select(
        F.explode(F.sequence(start, end - iv, iv)).alias(col))


def hour_spine_of(df: DataFrame, ts: str = "ts", interval: str = "1 hour",
                  col: str = "ts") -> DataFrame:
    """Hourly spine over the span of a frame: [floor(min), floor(max)+1h)."""
    iv = F.expr(f"INTERVAL {interval}")
    span = df.agg(F.min(hour_floor(ts)).alias("_lo"), F.max(hour_floor(ts)).alias("_hi"))
    return span.select(F.explode(F.sequence("_lo", "_hi", iv)).alias(col))


def date_spine(df: DataFrame, ts: str, col: str = "date") -> DataFrame:
    """Every date from Jan 1 of the first year to Dec 31 of the last (B1)."""
    yrs = df.agg(F.min(F.year(ts)).alias("_y0"), F.max(F.year(ts)).alias("_y1"))
    return yrs.select(F.explode(F.sequence(
        F.make_date("_y0", F.lit(1), F.lit(1)), F.make_date("_y1", F.lit(12), F.lit(31)),
        F.expr("INTERVAL 1 DAY"))).alias(col))


def resample_grid(hourly: DataFrame, series=("series_id",), ts: str = "ts",
                  interval: str = "1 hour") -> DataFrame:
    """Regular grid per series over its own span; empty buckets are NULL."""
    series = list(series)
    iv = F.expr(f"INTERVAL {interval}")
    span = hourly.groupBy(*series).agg(F.min(ts).alias("_lo"), F.max(ts).alias("_hi"))
    spine = span.select(*series, F.explode(F.sequence("_lo", "_hi", iv)).alias(ts))
    vals = [c for c in hourly.columns if c not in series + [ts]]
    return spine.join(hourly, series + [ts], "left").select(*series, ts, *vals)


def resample_drop_empty(grid: DataFrame, subset) -> DataFrame:
    """Drop the empty buckets of a grid by the target column(s)."""
    return grid.na.drop(subset=list(subset) if not isinstance(subset, str) else [subset])
