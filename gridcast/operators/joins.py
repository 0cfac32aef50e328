"""Time-keyed joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridcast.functions.calendar import hour_floor


def join_demand_weather(demand: DataFrame, weather: DataFrame, on: str = "ts") -> DataFrame:
    """Inner equi-join on the exact timestamp."""
    return demand.join(weather, on, "inner")


def holiday_membership(df: DataFrame, holidays: DataFrame, ts: str = "ts",
                       out: str = "is_public_holiday", dtype: str = "int") -> DataFrame:
    """0/1 flag: date(ts) is a public-holiday date.

    Existence join against the distinct public-holiday dates, which are
    bounded by the calendar (a few per year) and therefore broadcast.
    """
    from gridcast.operators.calendar_ops import flatten_holidays
    h = holidays
    if "is_public_holiday" not in h.columns:
        h = flatten_holidays(h)
    dates = h.where(F.col("is_public_holiday")).select(F.col("date").alias("_hd")).distinct()
    j = df.join(F.broadcast(dates), F.to_date(F.col(ts)) == F.col("_hd"), "left")
    return j.withColumn(out, F.col("_hd").isNotNull().cast(dtype)).drop("_hd")


def join_serving_history(demand: DataFrame, weather: DataFrame, calendar: DataFrame,
                         ts: str = "ts") -> DataFrame:
    """demand x weather on ts, calendar left-joined on DATE(ts)."""
    d = demand.select("series_id", F.col(ts).alias("timestamp"),
                      F.col("actual_demand").alias("target_demand"),
                      "daylight_savings_winter", "daylight_savings_summer")
    w = weather.select(F.col(ts).alias("timestamp"), "temperature")
    cal = calendar.select(F.col("date").alias("_d"), F.col("is_public_holiday").alias("_ph"))
    j = d.join(w, "timestamp", "inner").join(F.broadcast(cal), F.to_date("timestamp") == F.col("_d"), "left")
    return j.select("series_id", "timestamp", "target_demand", "daylight_savings_winter",
                    "daylight_savings_summer", F.coalesce("_ph", F.lit(False)).alias("is_public_holiday"),
                    "temperature")


def forecasting_view(demand: DataFrame, weather: DataFrame, calendar: DataFrame,
                     ts: str = "ts") -> DataFrame:
    """demand LEFT weather on hour-truncated keys LEFT calendar on date."""
    d = demand.withColumn("_h", hour_floor(ts))
    w = weather.select(hour_floor(ts).alias("_h"), F.col("temperature").alias("temperature_2m"),
                       F.col("relative_humidity").alias("relative_humidity_2m"), "rain", "snow_depth")
    cal = calendar.select(F.col("date").alias("_d"), "is_public_holiday", "is_national", "holiday_type")
    j = d.join(w, "_h", "left").join(F.broadcast(cal), F.to_date(F.col(ts)) == F.col("_d"), "left")
    return j.drop("_h", "_d")


def join_actual_forecast(actual: DataFrame, forecast: DataFrame, keys=("series_id", "ts"),
                         value: str = "demand_forecast") -> DataFrame:
    """Actual LEFT day-ahead forecast by hour; missing forecast -> 0.0."""
    j = actual.join(forecast, list(keys), "left")
    return j.withColumn(value, F.coalesce(F.col(value), F.lit(0.0)))


def join_predictions_features(preds: DataFrame, features: DataFrame,
                              keys=("series_id", "timestamp")) -> DataFrame:
    """Predictions LEFT feature frame on (series, timestamp)."""
    return preds.join(features, list(keys), "left")


def join_importance_correlation(importance: DataFrame, correlation: DataFrame,
                                keys=("series_id", "feature")) -> DataFrame:
    """Importance LEFT correlation by feature."""
    return importance.join(correlation, list(keys), "left")
