"""Forecast request (M4): history -> serving features -> future rows -> model -> bias.

Per series in parallel; the request arguments of the reference's HTTP
shape survive as keyword arguments (hours 1..168, as-of date text,
apply_bias_correction).
"""

from __future__ import annotations

from functools import reduce

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridcast.operators.ml import (
    choose_forecaster, fit_boosted, fit_forecaster, is_linear, linear_prediction, linear_terms, predict,
)
from gridcast.operators.scoring import apply_bias, shipped_bias_table
from gridcast.operators.series import latest_n_asof
from gridcast.plans.future import align_features, concat_history_future, future_features
from gridcast.plans.serve_features import serve_features
from gridcast.session import materialize


# Columns of the serving profile that mean the same in history and in future
# rows and are not computed from the row's own target.
FORECAST_FEATURES = [
    "hour_sin", "hour_cos", "dow_sin", "dow_cos", "month_sin", "month_cos", "is_weekend", "is_morning_ramp",
    "is_night", "is_peak_hour", "hour_squared", "temperature", "heating_demand", "is_cold",
    "demand_lag_24h", "demand_lag_168h",
]


def fit_served(frame: DataFrame) -> PipelineModel:
    """The forecaster, fitted on the profile that is served (M3)."""
    return fit_forecaster(frame, FORECAST_FEATURES)


def fit_best(train: DataFrame, validation: DataFrame) -> tuple[str, PipelineModel]:
    """The linear or the boosted forecaster, whichever errs less on the validation rows."""
    models = {"linear": fit_forecaster(train, FORECAST_FEATURES), "boosted": fit_boosted(train, FORECAST_FEATURES)}
    return choose_forecaster(models, validation, FORECAST_FEATURES)


#: Hours until a forecast becomes the lag of another one, and the feature that holds it.
FEEDBACK_HOURS, FEEDBACK = 24, "demand_lag_24h"


def predict_recursive(model: PipelineModel, future: DataFrame, features, hours: int, out: str = "predicted_demand",
                      series: str = "series_id") -> DataFrame:
    """Forecasts of future rows (series, timestamp, horizon, features), fed back as the lag of the hour a day later.

    A linear model is folded along the horizon per series, in one expression
    over at most 168 rows. Any other model runs day by day, each day's rows
    taking their lag from the day before, which is written first.
    """
    fed = FEEDBACK in features and hours > FEEDBACK_HOURS
    if not fed:
        return predict(model, future, features, out).select(series, "timestamp", "horizon", out)
    if is_linear(model):
        weight = F.lit(linear_terms(model, features)[1][FEEDBACK])
        row = F.struct("horizon", "timestamp", F.col(FEEDBACK).cast("double").alias("lag"),
                       linear_prediction(model, features, without=[FEEDBACK]).alias("rest"))
        rows = future.groupBy(series).agg(F.sort_array(F.collect_list(row)).alias("rows"))

        def step(done, r):
            lag = F.when(r["horizon"] <= FEEDBACK_HOURS, r["lag"]).otherwise(F.get(done, F.size(done) - FEEDBACK_HOURS))
            return F.array_append(done, r["rest"] + weight * lag)

        said = F.aggregate("rows", F.array().cast("array<double>"), step)
        return rows.select(series, F.inline(F.arrays_zip(F.col("rows.timestamp").alias("timestamp"), F.col("rows.horizon").alias("horizon"),
                                                         said.alias(out))))
    future, days, before = materialize(future, "forecast-future"), [], None
    for first in range(1, hours + 1, FEEDBACK_HOURS):
        rows = future.where(F.col("horizon").between(first, first + FEEDBACK_HOURS - 1))
        if before is not None:
            lag = before.select(series, (F.col("horizon") + FEEDBACK_HOURS).alias("horizon"), F.col(out).alias(FEEDBACK))
            rows = rows.drop(FEEDBACK).join(lag, [series, "horizon"])
        before = materialize(predict(model, rows, features, out).select(series, "timestamp", "horizon", out), "forecast-day")
        days.append(before)
    return reduce(DataFrame.unionByName, days)


def forecast(spark: SparkSession, history: DataFrame, model: PipelineModel, features,
             hours: int = 24, forecast_from_date: str | None = None, apply_bias_correction: bool = True,
             encoder: int = 48, bias_table: DataFrame | None = None) -> DataFrame:
    """timestamp, predicted_demand[, bias_correction, corrected_demand] per series.

    The history is always its latest encoder + 200 rows, up to the date if one is given.
    Beyond 24 hours, forecasts are the lags of later hours.
    """
    if not 1 <= int(hours) <= 168:
        raise ValueError("hours must be within 1..168")
    keep = encoder + 200
    hist = latest_n_asof(history, forecast_from_date, keep)
    feats = materialize(serve_features(hist, keep_pos=True), "forecast-history")
    fut = future_features(feats, hours)
    combined = align_features(concat_history_future(feats, fut, keep), features)
    out = predict_recursive(model, combined.where(F.col("horizon").isNotNull()), features, int(hours)).drop("horizon")
    if apply_bias_correction:
        out = apply_bias(out, bias_table if bias_table is not None else shipped_bias_table(spark))
    return out
