"""The feed refresh and the validation run, composed from their operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridcast.functions.calendar import dst_flags_day25
from gridcast.operators.dedupe import dedupe_keep_first, dedupe_keep_last, zero_unavailability
from gridcast.operators.resample import resample_hourly
from gridcast.operators.series import position_index
from gridcast.operators.validation import near_duplicate_remove, validation_report
from gridcast.session import materialize
from gridcast.sources.files import replace_range


def hourly_feed(readings: DataFrame) -> DataFrame:
    """Latest delivery per reading, hourly actuals, forecasts joined (absent ones are 0), DST flags, one row per hour."""
    kept = dedupe_keep_last(readings, ["series_id", "ts"], ["delivery", "reading_id"])
    actual = resample_hourly(kept, values={"load": "actual_demand"}, dst=False)
    said = resample_hourly(kept.where(F.col("forecast").isNotNull()), values={"forecast": "demand_forecast"}, dst=False)
    rows = actual.join(said, ["series_id", "ts"], "left").withColumn("demand_forecast", F.coalesce("demand_forecast", F.lit(0.0)))
    return dedupe_keep_first(rows.select("*", *dst_flags_day25("ts")), ["series_id", "ts"], "actual_demand")


def refresh_feed(spark: SparkSession, readings: DataFrame, demand_path: str, unavailability_path: str | None = None) -> DataFrame:
    """Replace the range that a fetch covers in the day-partitioned demand table and its companion; returns the report."""
    hourly = materialize(hourly_feed(readings), "feed-hourly")
    report = replace_range(spark, demand_path, hourly)
    if unavailability_path:
        replace_range(spark, unavailability_path, zero_unavailability(hourly))
    return report


def clean_and_report(spark: SparkSession, df: DataFrame, path: str, cols, ts: str = "timestamp", target: str = "target_demand",
                     series: str = "series_id") -> DataFrame:
    """Drop near duplicates, save what is left under `path`, and report all checks on it with the row counts."""
    numbered = materialize(position_index(df, series, ts, pos="_id"), "validation-rows")
    near_duplicate_remove(numbered, "_id", ts, list(cols), series=series).drop("_id").write.mode("overwrite").parquet(path)
    cleaned = spark.read.parquet(path)
    before = numbered.groupBy(series).agg(F.count(F.lit(1)).alias("rows_before"))
    after = cleaned.groupBy(series).agg(F.count(F.lit(1)).alias("rows_after"))
    return validation_report(cleaned, ts, target, series).join(before, series).join(after, series)
