"""Feature profile ``train`` (F1-F6, S5): 58 features + timestamp, target, season.

Shape: one position index, one per-series stats aggregate (joined back),
one blocked window stage for every lag / rolling column, one fill stage,
then flat projections. No Python in the hot path.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridcast.functions.calendar import season_train
from gridcast.functions.numeric import clip, flag
from gridcast.operators.series import (
    DEFAULT_BLOCK_ROWS, block_window, core_only, ffill_bfill, positioned_blocks, rolling_std,
)

# Column names and order of the training frame.
TRAIN_FEATURES = [
    "hour_sin", "hour_cos", "dow_sin", "month_cos",
    "dow_0", "dow_1", "dow_2", "dow_3", "dow_4", "dow_5", "dow_6",
    "is_weekend", "is_weekday", "is_public_holiday",
    "is_monday_after_weekend", "is_friday_before_weekend",
    "is_early_morning", "is_morning_ramp", "is_night",
    "day_transition_type", "is_peak_hour", "is_valley_hour", "hour_squared",
    "daylight_savings_winter", "daylight_savings_summer",
    "temperature", "heating_demand", "heating_demand_sq",
    "temp_severity", "heating_demand_log", "monday_cold_multiplier", "is_cold",
    "regime_0", "regime_1", "regime_2", "regime_3",
    "demand_lag_24h_norm", "demand_lag_168h_norm", "demand_delta_24h",
    "demand_lag_ratio", "lag_reliability", "demand_lag_adjusted",
    "transition_adjustment", "demand_rolling_std_7d",
    "lag_24h_was_weekend", "lag_168h_was_weekend",
    "demand_lag_24h_sq", "demand_lag_168h_sq", "demand_lag_24h_log", "temp_lag_24h",
    "peak_lag_interaction", "peak_heating_interaction", "weekend_temp_interaction",
    "heating_hour_cos_product", "temp_lag_ratio_interaction",
    "night_temp_interaction", "weekend_transition_temp", "dow_sin_temp",
]
TRAIN_COLUMNS = ["timestamp", "target_demand", "season"] + TRAIN_FEATURES

TEMPORAL_BLOCK = ["hour_sin", "hour_cos", "dow_sin", "month_cos"] + [f"dow_{i}" for i in range(7)] + [
    "is_weekend", "is_weekday", "is_monday_after_weekend", "is_friday_before_weekend",
    "is_early_morning", "is_morning_ramp", "is_night", "is_peak_hour", "is_valley_hour",
    "hour_squared", "season", "daylight_savings_winter", "daylight_savings_summer",
    "day_transition_type"]
WEATHER_BLOCK = ["temperature", "heating_demand", "heating_demand_sq", "temp_severity",
                 "heating_demand_log", "is_cold", "temp_lag_24h", "monday_cold_multiplier"]
REGIME_BLOCK = ["regime_0", "regime_1", "regime_2", "regime_3"]
LAG_BLOCK = ["demand_lag_24h_norm", "demand_lag_168h_norm", "demand_delta_24h", "demand_lag_ratio",
             "lag_reliability", "lag_24h_was_weekend", "lag_168h_was_weekend", "demand_lag_adjusted",
             "transition_adjustment", "demand_rolling_std_7d", "demand_lag_24h_sq",
             "demand_lag_168h_sq", "demand_lag_24h_log"]
INTERACTION_BLOCK = ["peak_lag_interaction", "peak_heating_interaction", "weekend_temp_interaction",
                     "heating_hour_cos_product", "temp_lag_ratio_interaction", "night_temp_interaction",
                     "weekend_transition_temp", "dow_sin_temp"]

TWO_PI = 2 * math.pi


def temporal_columns(ts: str):
    """cyclic, one-hot, flags, season, DST (month rule), transition type."""
    h, d, m = F.hour(ts), F.weekday(ts), F.month(ts)
    cols = [
        F.sin(F.lit(TWO_PI) * h / F.lit(24)).alias("hour_sin"),
        F.cos(F.lit(TWO_PI) * h / F.lit(24)).alias("hour_cos"),
        F.sin(F.lit(TWO_PI) * d / F.lit(7)).alias("dow_sin"),
        F.cos(F.lit(TWO_PI) * m / F.lit(12)).alias("month_cos"),
    ]
    cols += [flag(d == i).alias(f"dow_{i}") for i in range(7)]
    cols += [
        flag(d >= 5).alias("is_weekend"), flag(d < 5).alias("is_weekday"),
        flag((d == 0) & (h < 12)).alias("is_monday_after_weekend"),
        flag((d == 4) & (h >= 12)).alias("is_friday_before_weekend"),
        flag((h >= 5) & (h < 8)).alias("is_early_morning"),
        flag((h >= 6) & (h < 10)).alias("is_morning_ramp"),
        flag((h >= 22) | (h < 6)).alias("is_night"),
        flag((h >= 9) & (h < 20)).alias("is_peak_hour"),
        flag((h >= 0) & (h < 5)).alias("is_valley_hour"),
        (h * h / F.lit(576.0)).alias("hour_squared"),
        season_train(m).alias("season"),
        flag(m.isin(11, 12, 1, 2, 3)).alias("daylight_savings_winter"),
        flag(m.isin(4, 5, 6, 7, 8, 9, 10)).alias("daylight_savings_summer"),
        F.when(d == 6, 1.0).when(d == 4, 2.0).otherwise(0.0).alias("day_transition_type"),
    ]
    return cols


def weather_columns(T: Column, d: Column):
    """F2 without the lag: heating terms, and severity against the series' temperature statistics."""
    heating = clip(F.lit(18.0) - T, lower=0.0)
    return [heating.alias("heating_demand"), (heating * heating).alias("heating_demand_sq"),
            F.try_divide(F.abs(T - F.col("_mu_t")), F.col("_sd_t")).alias("temp_severity"),
            F.log1p(heating).alias("heating_demand_log"), flag(T < 5).alias("is_cold"),
            clip(flag(d == 0) * heating, upper=20.0).alias("monday_cold_multiplier")]


def regime_columns(T: Column):
    """temperature regimes, row by row."""
    return [flag(T < 0).alias("regime_0"), flag((T >= 0) & (T < 10)).alias("regime_1"),
            flag((T >= 10) & (T < 20)).alias("regime_2"), flag(T >= 20).alias("regime_3")]


def train_features(df: DataFrame, series: str = "series_id", ts: str = "timestamp",
                   demand: str = "demand", temperature: str = "temperature_2m",
                   holiday: str = "is_public_holiday", block_rows: int = DEFAULT_BLOCK_ROWS,
                   drop_incomplete: bool = True, keep_pos: bool = False, stage: bool = True) -> DataFrame:
    """Training frame per series: F1..F5, projected to TRAIN_COLUMNS (S5), nulls dropped.

    Frame-global mean/std are per series over the given frame (the load
    window decides them, as in the reference). With ``stage`` the input is
    written once to the shared folder, so the stats, position and window
    branches read that table instead of recomputing the raw aggregation.
    """
    df = df.select(series, ts, demand, temperature, holiday)
    if stage:
        from gridcast.session import materialize
        df = materialize(df, "train-input")
    stats = df.groupBy(series).agg(
        F.avg(demand).alias("_mu_d"), F.stddev_samp(demand).alias("_sd_d"),
        F.avg(temperature).alias("_mu_t"), F.stddev_samp(temperature).alias("_sd_t"))
    # one blocked window stage over the base columns: every lag and the 168-row rolling std
    w = block_window(series, "pos")
    base = df.select(series, ts, F.col(demand).alias("_D"), F.col(temperature).alias("temperature"),
                     F.col(holiday).cast("int").alias("is_public_holiday"))
    blk = positioned_blocks(base, series, ts, "pos", before=168, block_rows=block_rows, stats=stats)
    z = F.try_divide(F.col("_D") - F.col("_mu_d"), F.col("_sd_d"))
    dow = F.weekday(ts)
    blk = rolling_std(blk, "_D", 168, 24, "_rstd", series)
    lagged = core_only(blk.withColumn("_z", z).select(
        "*",
        F.lag("temperature", 24).over(w).alias("temp_lag_24h"),
        F.lag("_z", 24).over(w).alias("demand_lag_24h_norm"),
        F.lag("_z", 168).over(w).alias("demand_lag_168h_norm"),
        (F.col("_z") - F.lag("_z", 24).over(w)).alias("demand_delta_24h"),
        flag(F.lag("_D", 24).over(w).isNotNull(), "double").alias("_v24"),
        flag(F.lag("_D", 168).over(w).isNotNull(), "double").alias("_v168"),
        flag(F.lag(dow, 1).over(w).isin(5, 6)).alias("lag_24h_was_weekend"),
        flag(F.lag(dow, 7).over(w).isin(5, 6)).alias("lag_168h_was_weekend"),
    )).drop("_z")
    if stage:
        # the fill reads the lagged frame twice (in-block fill, per-block carry):
        # write the base columns and lags once rather than recompute them per branch
        from gridcast.session import materialize
        lagged = materialize(lagged, "train-lagged")
    filled = ffill_bfill(lagged,
                         ["temp_lag_24h", "demand_lag_24h_norm", "demand_lag_168h_norm",
                          "demand_delta_24h", "_rstd"], series, "pos")
    filled = filled.select("*", F.col("_D").alias("target_demand"), *temporal_columns(ts),
                           *weather_columns(F.col("temperature"), dow), *regime_columns(F.col("temperature")))

    l24, l168 = F.col("demand_lag_24h_norm"), F.col("demand_lag_168h_norm")
    same = (F.col("lag_24h_was_weekend") == F.col("is_weekend")).cast("double")
    ratio = clip(l24 / clip(l168, lower=0.01), -5.0, 5.0)
    out = filled.select(
        "*",
        ratio.alias("demand_lag_ratio"),
        (F.col("_v24") * F.lit(0.7) + F.col("_v168") * F.lit(0.3)).alias("lag_reliability"),
        (same * l24 + (F.lit(1.0) - same) * F.lit(0.5) * (l24 + l168)).alias("demand_lag_adjusted"),
        (F.col("is_monday_after_weekend") * F.lit(0.1)
         - F.col("is_friday_before_weekend") * F.lit(0.05)).alias("transition_adjustment"),
        F.try_divide(F.col("_rstd"), F.col("_sd_d")).alias("demand_rolling_std_7d"),
        (l24 * l24).alias("demand_lag_24h_sq"), (l168 * l168).alias("demand_lag_168h_sq"),
        F.log1p(clip(l24, lower=0.0)).alias("demand_lag_24h_log"),
        (F.col("is_peak_hour") * l24).alias("peak_lag_interaction"),
        (F.col("is_peak_hour") * F.col("heating_demand")).alias("peak_heating_interaction"),
        (F.col("is_weekend") * F.col("temperature")).alias("weekend_temp_interaction"),
        (F.col("heating_demand") * F.col("hour_cos")).alias("heating_hour_cos_product"),
        (F.col("temperature") * ratio).alias("temp_lag_ratio_interaction"),
        (F.col("is_night") * F.col("temperature")).alias("night_temp_interaction"),
        (F.col("day_transition_type") * F.col("temperature") * F.col("is_weekend"))
        .alias("weekend_transition_temp"),
        (F.col("dow_sin") * F.col("temperature")).alias("dow_sin_temp"),
    )
    cols = [series] + (["pos"] if keep_pos else []) + TRAIN_COLUMNS
    out = out.select(*cols)
    if drop_incomplete:
        out = out.na.drop("any", subset=TRAIN_COLUMNS)
    return out
