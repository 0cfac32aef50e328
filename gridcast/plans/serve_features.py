"""Feature profile ``serve`` (F7-F11, F13): 86 columns over a serving history.

Same shape as the train profile: per-series stats joined back, one
blocked window stage (24/168-row lags, 168-row rolling std), flat
projections. Flags are doubles, DST flags stay boolean as stored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridcast.functions.calendar import season_serve
from gridcast.functions.numeric import clip, flag
from gridcast.operators.series import (
    DEFAULT_BLOCK_ROWS, block_window, core_only, positioned_blocks, rolling_std,
)

SCALE = 10_000.0
TWO_PI = 2 * math.pi

# Column names and order of the serving frame.
SERVE_COLUMNS = [
    "timestamp", "target_demand", "daylight_savings_winter", "daylight_savings_summer",
    "is_public_holiday", "temperature", "hour", "dow", "month", "year",
    "hour_sin", "hour_cos", "dow_sin", "dow_cos", "month_sin", "month_cos",
    "dow_0", "dow_1", "dow_2", "dow_3", "dow_4", "dow_5", "dow_6",
    "is_weekend", "is_weekday", "is_monday_after_weekend", "is_early_morning", "is_morning_ramp",
    "is_night", "is_peak_hour", "is_peak_period", "is_valley_hour", "hour_squared",
    "day_transition_type", "season",
    "heating_demand", "heating_demand_sq", "heating_demand_log", "temp_severity", "is_cold",
    "heating_evening_impact", "monday_cold_multiplier",
    "regime_0", "regime_1", "regime_2", "regime_3",
    "demand_lag_24h", "demand_lag_168h", "demand_lag_24h_norm", "demand_lag_168h_norm",
    "demand_lag_ratio", "demand_rolling_std_7d",
    "lag_24h_was_weekend", "lag_24h_was_saturday", "lag_24h_was_sunday", "lag_168h_was_weekend",
    "lag_reliability", "ignore_lag_signal",
    "baseline_demand_norm", "demand_vs_baseline", "demand_lag_24h_dampened", "demand_lag_168h_dampened",
    "demand_delta_24h", "demand_lag_adjusted", "demand_lag_24h_sq", "demand_lag_168h_sq",
    "demand_lag_24h_log", "seasonal_weekly_pattern",
    "peak_lag_interaction", "temp_lag_ratio_interaction", "peak_heating_interaction",
    "weekend_temp_interaction", "heating_hour_cos_product", "temp_peak_interaction",
    "temp_morning_ramp_interaction", "temp_night_interaction", "monday_morning_heating",
    "evening_heating_interaction", "weekend_transition_temp", "dow_sin_temp", "temp_lag_24h",
    "expected_transition_delta", "transition_lag_penalty", "morning_ramp_lag_adjustment",
    "demand_lag_correction", "is_week_after_holiday",
]
ZERO_COLUMNS = ["expected_transition_delta", "transition_lag_penalty", "morning_ramp_lag_adjustment",
                "demand_lag_correction", "is_week_after_holiday"]

TEMPORAL_BLOCK = ["hour", "dow", "month", "year", "hour_sin", "hour_cos", "dow_sin", "dow_cos",
                  "month_sin", "month_cos"] + [f"dow_{i}" for i in range(7)] + [
    "is_weekend", "is_weekday", "is_public_holiday", "is_monday_after_weekend", "is_early_morning",
    "is_morning_ramp", "is_night", "is_peak_hour", "is_peak_period", "is_valley_hour",
    "hour_squared", "day_transition_type", "season"]
WEATHER_BLOCK = ["heating_demand", "heating_demand_sq", "heating_demand_log", "temp_severity", "is_cold",
                 "heating_evening_impact", "monday_cold_multiplier", "regime_0", "regime_1", "regime_2",
                 "regime_3"]
LAG_BLOCK = ["demand_lag_24h", "demand_lag_168h", "demand_lag_24h_norm", "demand_lag_168h_norm",
             "demand_lag_ratio", "demand_rolling_std_7d", "lag_24h_was_weekend", "lag_24h_was_saturday",
             "lag_24h_was_sunday", "lag_168h_was_weekend", "lag_reliability", "ignore_lag_signal",
             "baseline_demand_norm", "demand_vs_baseline", "demand_lag_24h_dampened",
             "demand_lag_168h_dampened", "demand_delta_24h", "demand_lag_adjusted", "demand_lag_24h_sq",
             "demand_lag_168h_sq", "demand_lag_24h_log", "seasonal_weekly_pattern"]
INTERACTION_BLOCK = ["peak_lag_interaction", "temp_lag_ratio_interaction", "peak_heating_interaction",
                     "weekend_temp_interaction", "heating_hour_cos_product", "temp_peak_interaction",
                     "temp_morning_ramp_interaction", "temp_night_interaction", "monday_morning_heating",
                     "evening_heating_interaction", "weekend_transition_temp", "dow_sin_temp",
                     "temp_lag_24h"] + ZERO_COLUMNS


def calendar_columns(ts: str | Column) -> list[Column]:
    """Time parts and calendar flags shared by history and future rows."""
    t = F.col(ts) if isinstance(ts, str) else ts
    h, d, m, y = F.hour(t), F.weekday(t), F.month(t), F.year(t)
    cols = [h.alias("hour"), d.alias("dow"), m.alias("month"), y.alias("year"),
            F.sin(F.lit(TWO_PI) * h / F.lit(24)).alias("hour_sin"),
            F.cos(F.lit(TWO_PI) * h / F.lit(24)).alias("hour_cos"),
            F.sin(F.lit(TWO_PI) * d / F.lit(7)).alias("dow_sin"),
            F.cos(F.lit(TWO_PI) * d / F.lit(7)).alias("dow_cos"),
            F.sin(F.lit(TWO_PI) * (m - 1) / F.lit(12)).alias("month_sin"),
            F.cos(F.lit(TWO_PI) * (m - 1) / F.lit(12)).alias("month_cos")]
    cols += [flag(d == i, "double").alias(f"dow_{i}") for i in range(7)]
    cols += [flag(d >= 5, "double").alias("is_weekend"), flag(d < 5, "double").alias("is_weekday"),
             flag(d == 0, "double").alias("is_monday_after_weekend"),
             flag((h >= 0) & (h <= 4), "double").alias("is_early_morning"),
             flag((h >= 4) & (h <= 10), "double").alias("is_morning_ramp"),
             flag((h >= 22) | (h <= 4), "double").alias("is_night"),
             flag((h >= 9) & (h <= 12), "double").alias("is_peak_hour"),
             flag((h >= 9) & (h <= 12), "double").alias("is_peak_period"),
             flag((h == 2) | (h == 3), "double").alias("is_valley_hour"),
             ((h / F.lit(24)) * (h / F.lit(24))).alias("hour_squared"),
             season_serve(m).alias("season"),
             flag(y == 2019, "double").alias("regime_0"), flag(y == 2020, "double").alias("regime_1"),
             flag(y.isin(2021, 2022), "double").alias("regime_2"), flag(y >= 2023, "double").alias("regime_3")]
    return cols


def weather_columns(T: Column, h: Column, d: Column) -> list[Column]:
    """Heating-degree block (F8) for a temperature column."""
    heat = F.greatest(F.lit(18.0) - T, F.lit(0.0))
    heat = F.when(T.isNull(), F.lit(None).cast("double")).otherwise(heat)  # np.maximum keeps NaN
    return [heat.alias("heating_demand"), (heat * heat).alias("heating_demand_sq"),
            F.log1p(heat).alias("heating_demand_log"),
            clip((F.lit(18.0) - T) / F.lit(28.0), 0.0, 1.0).alias("temp_severity"),
            flag(T < 5, "double").alias("is_cold"),
            (heat * flag((h >= 17) & (h <= 20), "double")).alias("heating_evening_impact"),
            (flag(d == 0, "double") * heat).alias("monday_cold_multiplier")]


def interaction_columns() -> list[Column]:
    """Products (F10); expects the other blocks as columns."""
    c = F.col
    return [(c("is_peak_hour") * c("demand_lag_24h_norm")).alias("peak_lag_interaction"),
            (c("temperature") * c("demand_lag_ratio")).alias("temp_lag_ratio_interaction"),
            (c("is_peak_hour") * c("heating_demand")).alias("peak_heating_interaction"),
            (c("is_weekend") * c("temperature")).alias("weekend_temp_interaction"),
            (c("heating_demand") * c("hour_cos")).alias("heating_hour_cos_product"),
            (c("temperature") * c("is_peak_hour")).alias("temp_peak_interaction"),
            (c("temperature") * c("is_morning_ramp")).alias("temp_morning_ramp_interaction"),
            (c("temperature") * c("is_night")).alias("temp_night_interaction"),
            (flag((c("dow") == 0) & (c("hour") <= 10), "double") * c("heating_demand"))
            .alias("monday_morning_heating"),
            (flag((c("hour") >= 17) & (c("hour") <= 20), "double") * c("heating_demand"))
            .alias("evening_heating_interaction"),
            (c("day_transition_type") * c("temperature")).alias("weekend_transition_temp"),
            (c("dow_sin") * c("temperature")).alias("dow_sin_temp")]


def serve_features(df: DataFrame, series: str = "series_id", ts: str = "timestamp",
                   block_rows: int = DEFAULT_BLOCK_ROWS, keep_pos: bool = False, stage: bool = True) -> DataFrame:
    """Serving frame per series (F11) from (series, timestamp, target_demand,
    daylight_savings_winter/summer, is_public_holiday, temperature).

    With ``stage`` the input is written once to the shared folder so the
    stats / position / window branches do not recompute it.
    """
    if stage:
        from gridcast.session import materialize
        df = materialize(df, "serve-input")
    stats = df.groupBy(series).agg(F.avg("target_demand").alias("_mu"),
                                   F.stddev_samp("target_demand").alias("_sd"))
    T, D = F.col("temperature"), F.col("target_demand")
    h, d = F.hour(ts), F.weekday(ts)
    base = df.select(series, ts, "target_demand", "daylight_savings_winter", "daylight_savings_summer",
                     F.col("is_public_holiday").cast("double").alias("is_public_holiday"), "temperature")
    w = block_window(series, "pos")
    blk = positioned_blocks(base, series, ts, "pos", before=168, block_rows=block_rows, stats=stats)
    blk = rolling_std(blk, "target_demand", 168, 24, "_rstd", series)
    lagged = core_only(blk.select(
        "*",
        F.lag("target_demand", 24).over(w).alias("_l24"),
        F.lag("target_demand", 168).over(w).alias("_l168"),
        F.lag(d, 24).over(w).alias("_pdow"),
        F.lag("temperature", 24).over(w).alias("_t24")))
    lagged = lagged.select("*", *calendar_columns(ts), *weather_columns(T, h, d))
    mu, sd = F.col("_mu"), F.col("_sd")
    l24 = F.coalesce(F.col("_l24"), mu)
    l168 = F.coalesce(F.col("_l168"), mu)
    prev = F.coalesce(F.col("_pdow"), F.col("dow"))
    dow = F.col("dow")
    x = lagged.select(
        "*",
        F.when((prev >= 5) & (dow < 5), 1.0).when((prev < 5) & (dow >= 5), 2.0).otherwise(0.0)
        .alias("day_transition_type"),
        l24.alias("demand_lag_24h"), l168.alias("demand_lag_168h"),
        (l24 / F.lit(SCALE)).alias("demand_lag_24h_norm"), (l168 / F.lit(SCALE)).alias("demand_lag_168h_norm"),
        clip(l24 / F.when(l168 == 0, F.lit(1.0)).otherwise(l168), 0.7, 1.3).alias("demand_lag_ratio"),
        (F.coalesce(F.col("_rstd"), sd) / F.lit(SCALE)).alias("demand_rolling_std_7d"),
        flag(F.col("_pdow") >= 5, "double").alias("lag_24h_was_weekend"),
        flag(F.col("_pdow") == 5, "double").alias("lag_24h_was_saturday"),
        flag(F.col("_pdow") == 6, "double").alias("lag_24h_was_sunday"),
        F.col("is_weekend").alias("lag_168h_was_weekend"),
        F.coalesce(F.col("_t24"), T).alias("temp_lag_24h"),
    )
    lw = F.col("lag_24h_was_weekend")
    x = x.select(
        "*",
        F.when(F.col("is_weekend") == lw, 1.0).otherwise(0.5).alias("lag_reliability"),
        flag(((dow == 0) & (lw == 1)) | ((dow == 5) & (lw == 0)), "double").alias("ignore_lag_signal"),
        (mu / F.lit(SCALE)).alias("baseline_demand_norm"),
        ((D - mu) / F.lit(SCALE)).alias("demand_vs_baseline"),
        (F.col("demand_lag_24h_norm") * F.lit(0.8)).alias("demand_lag_24h_dampened"),
        (F.col("demand_lag_168h_norm") * F.lit(0.8)).alias("demand_lag_168h_dampened"),
        ((D - F.col("demand_lag_24h")) / F.lit(SCALE)).alias("demand_delta_24h"),
        F.col("demand_lag_24h_norm").alias("demand_lag_adjusted"),
        (F.col("demand_lag_24h_norm") * F.col("demand_lag_24h_norm")).alias("demand_lag_24h_sq"),
        (F.col("demand_lag_168h_norm") * F.col("demand_lag_168h_norm")).alias("demand_lag_168h_sq"),
        F.log1p(F.col("demand_lag_24h_norm")).alias("demand_lag_24h_log"),
        F.col("demand_lag_168h_norm").alias("seasonal_weekly_pattern"),
        *[F.lit(0.0).alias(z) for z in ZERO_COLUMNS],
    )
    x = x.select("*", *interaction_columns())
    return x.select(series, *(["pos"] if keep_pos else []), *SERVE_COLUMNS)
