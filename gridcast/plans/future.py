"""Future rows (F12), history/future concat (S3), model-feature alignment.

Future rows are generated per series in parallel: the last-row state is a
``max_by`` aggregate, the horizon is ``explode(sequence(1, H))`` and the
two positional lag look-ups are equi-joins on (series, pos) against only
the tail of the history that can be referenced (last 169 positions).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridcast.functions.numeric import clip, flag
from gridcast.operators.series import position_index
from gridcast.plans.serve_features import (
    SCALE, SERVE_COLUMNS, ZERO_COLUMNS, calendar_columns, interaction_columns, weather_columns,
)


def future_features(history: DataFrame, hours: int = 24, series: str = "series_id",
                    ts: str = "timestamp") -> DataFrame:
    """H future rows per series after the last history timestamp (A.3 rules)."""
    hist = history if "pos" in history.columns else position_index(history, series, ts)
    state = hist.groupBy(series).agg(
        F.max_by(F.struct(F.col(ts).alias("ts"), F.col("temperature").alias("t"),
                          F.col("daylight_savings_winter").alias("w"),
                          F.col("daylight_savings_summer").alias("s")), "pos").alias("_last"),
        F.avg("target_demand").alias("_mu"), F.stddev_samp("target_demand").alias("_sd"),
        F.count(F.lit(1)).alias("_n"))
    tail = (hist.select(series, "pos", "target_demand").join(state.select(series, "_n"), series)
            .where(F.col("pos") >= F.col("_n") - 169).select(series, "pos", "target_demand"))
    fut = state.select("*", F.explode(F.sequence(F.lit(1), F.lit(hours))).alias("_h"))
    fut = fut.select(
        "*",
        (F.col("_last.ts") + F.make_interval(hours=F.col("_h"))).cast("timestamp_ntz").alias(ts),
        (F.col("_n") - 24 + F.col("_h") - 1).alias("_i24"),
        (F.col("_n") - 168 + F.col("_h") - 1).alias("_i168"))
    t24 = tail.select(series, F.col("pos").alias("_i24"), F.col("target_demand").alias("_d24"))
    t168 = tail.select(series, F.col("pos").alias("_i168"), F.col("target_demand").alias("_d168"))
    fut = fut.join(t24, [series, "_i24"], "left").join(t168, [series, "_i168"], "left")

    def lookup(i, v):
        return F.when((F.col(i) >= 0) & (F.col(i) < F.col("_n")), F.col(v)).otherwise(F.col("_mu"))

    T = F.col("_last.t")
    h, d = F.hour(ts), F.weekday(ts)
    x = fut.select(
        series, ts, F.col("_h").alias("horizon"), "_mu", "_sd",
        F.col("_mu").alias("target_demand"), T.alias("temperature"),
        F.col("_last.w").alias("daylight_savings_winter"), F.col("_last.s").alias("daylight_savings_summer"),
        F.lit(0.0).alias("is_public_holiday"),
        *calendar_columns(ts), *weather_columns(T, h, d),
        lookup("_i24", "_d24").alias("demand_lag_24h"), lookup("_i168", "_d168").alias("demand_lag_168h"),
        F.weekday(F.col(ts) - F.expr("INTERVAL 24 HOURS")).alias("_prev"),
    )
    l24, l168, prev, dow, hr = (F.col("demand_lag_24h"), F.col("demand_lag_168h"), F.col("_prev"),
                                F.col("dow"), F.col("hour"))
    x = x.select(
        "*",
        F.lit(0.0).alias("day_transition_type"),
        (l24 / F.lit(SCALE)).alias("demand_lag_24h_norm"), (l168 / F.lit(SCALE)).alias("demand_lag_168h_norm"),
        clip(F.when(l168 == 0, F.lit(1.0)).otherwise(l24 / l168), 0.7, 1.3).alias("demand_lag_ratio"),
        (F.col("_sd") / F.lit(SCALE)).alias("demand_rolling_std_7d"),
        flag(prev >= 5, "double").alias("lag_24h_was_weekend"),
        flag(prev == 5, "double").alias("lag_24h_was_saturday"),
        flag(prev == 6, "double").alias("lag_24h_was_sunday"),
        flag(dow >= 5, "double").alias("lag_168h_was_weekend"),
        F.when(((dow == 0) & (hr <= 10)) | ((dow == 5) & (hr <= 10)), 0.5).otherwise(1.0)
        .alias("lag_reliability"),
        flag(((dow == 0) & (prev == 6)) | ((dow == 5) & (prev == 4)), "double").alias("ignore_lag_signal"),
        (F.col("_mu") / F.lit(SCALE)).alias("baseline_demand_norm"),
        F.lit(0.0).alias("demand_vs_baseline"),
        (l24 / F.lit(SCALE) * F.lit(0.8)).alias("demand_lag_24h_dampened"),
        (l168 / F.lit(SCALE) * F.lit(0.8)).alias("demand_lag_168h_dampened"),
        F.lit(0.0).alias("demand_delta_24h"),
        (l24 / F.lit(SCALE)).alias("demand_lag_adjusted"),
        ((l24 / F.lit(SCALE)) * (l24 / F.lit(SCALE))).alias("demand_lag_24h_sq"),
        ((l168 / F.lit(SCALE)) * (l168 / F.lit(SCALE))).alias("demand_lag_168h_sq"),
        F.log1p(l24 / F.lit(SCALE)).alias("demand_lag_24h_log"),
        (l168 / F.lit(SCALE)).alias("seasonal_weekly_pattern"),
        *[F.lit(0.0).alias(z) for z in ZERO_COLUMNS],
        F.col("temperature").alias("temp_lag_24h"),
    )
    x = x.select("*", *[c for c in interaction_columns()])
    return x.select(series, "horizon", *SERVE_COLUMNS)


def concat_history_future(history: DataFrame, future: DataFrame, keep: int,
                          series: str = "series_id") -> DataFrame:
    """Last ``keep`` history rows + future rows, one position index.

    Positions are arithmetic on the known counts, so no second sort.
    """
    n = history.groupBy(series).agg(F.max("pos").alias("_last"))
    h = (history.join(n, series).where(F.col("pos") > F.col("_last") - keep)
         .withColumn("time_idx", F.col("pos") - F.greatest(F.col("_last") - keep + 1, F.lit(0)))
         .withColumn("_kept", F.least(F.col("_last") + 1, F.lit(keep))).drop("_last"))

    kept = h.groupBy(series).agg(F.max("_kept").alias("_kept"))
    f = future.join(kept, series).withColumn("time_idx", F.col("_kept") + F.col("horizon") - 1)
    out = h.drop("_kept", "pos").unionByName(f.drop("_kept"), allowMissingColumns=True)
    return out.withColumn("time_idx", F.col("time_idx").cast("long"))


def align_features(df: DataFrame, features) -> DataFrame:
    """Add every model feature the frame lacks as 0.0."""
    missing = [f for f in features if f not in df.columns]
    return df.select("*", *[F.lit(0.0).alias(f) for f in missing])
