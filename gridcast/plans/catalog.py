"""Registered queries: name -> callable(spark, sf_dir) -> DataFrame.

Each query reads the given tables (or tables Spark derives from them)
in full and ends in ``finish`` (doubles rounded, -0.0 removed) so the
DuckDB oracle can compare values exactly.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridcast.functions.numeric import round_doubles
from gridcast.sources import bindings as B

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(name: str, digits: int = 6):
    def deco(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return round_doubles(fn(spark, sf_dir), digits)
        run.__name__ = name
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        return fn
    return deco


def _train_frame(spark, sf_dir, **kw):
    from gridcast.plans.train_features import train_features
    return train_features(B.train_input(spark, sf_dir), **kw)


# --------------------------------------------------------------------------
# aggregations / windows (first slice)
# --------------------------------------------------------------------------
@query("resample_hourly")
def q_resample_hourly(spark, sf_dir):
    """G1: sub-hourly readings -> hourly means per series."""
    return B.demand_hourly(spark, sf_dir)


@query("features_train")
def q_features_train(spark, sf_dir):
    """the whole training frame per series."""
    return _train_frame(spark, sf_dir)


def _serve_frame(spark, sf_dir, **kw):
    from gridcast.plans.serve_features import serve_features
    return serve_features(B.serve_input(spark, sf_dir), **kw)


def _serve_positions(spark, sf_dir):
    """Serving history with positions and no features, written once: it feeds several branches."""
    from gridcast.operators.series import position_index
    from gridcast.session import materialize
    hist = B.serve_input(spark, sf_dir).withColumn("is_public_holiday", F.col("is_public_holiday").cast("double"))
    return materialize(position_index(hist, "series_id", "timestamp"), "serve-positions")


@query("features_serve")
def q_features_serve(spark, sf_dir):
    """the whole serving frame per series over its full history."""
    return _serve_frame(spark, sf_dir)


@query("future_features")
def q_future_features(spark, sf_dir):
    """24 future rows per series after the serving history."""
    from gridcast.plans.future import future_features
    return future_features(_serve_positions(spark, sf_dir), hours=24)


# --------------------------------------------------------------------------
# feature blocks
# --------------------------------------------------------------------------
def _train_block(cols):
    def fn(spark, sf_dir):
        return _train_frame(spark, sf_dir, drop_incomplete=False).select("series_id", "timestamp", *cols)
    return fn


def _serve_block(cols):
    def fn(spark, sf_dir):
        return _serve_frame(spark, sf_dir).select("series_id", "timestamp", *cols)
    return fn


def _register_blocks():
    from gridcast.plans import serve_features as S
    from gridcast.plans import train_features as T

    def train_rows(spark, sf_dir, cols):  # row by row: no lags, no statistics
        return B.train_input(spark, sf_dir).select("series_id", "timestamp", F.col("is_public_holiday").cast("int").alias(
            "is_public_holiday"), *cols)

    def serve_weather(spark, sf_dir):
        t, ts = F.col("temperature"), "timestamp"
        cols = {c: x for c, x in zip(S.WEATHER_BLOCK[:7], S.weather_columns(t, F.hour(ts), F.weekday(ts)))}
        x = B.serve_input(spark, sf_dir).select("series_id", ts, *cols.values(), *S.calendar_columns(ts))
        return x.select("series_id", ts, *S.WEATHER_BLOCK)

    query("feat_train_temporal")(lambda spark, sf_dir: train_rows(spark, sf_dir, T.temporal_columns("timestamp")))
    query("feat_train_weather")(_train_block(T.WEATHER_BLOCK))
    query("feat_train_regime")(lambda spark, sf_dir: train_rows(
        spark, sf_dir, T.regime_columns(F.col("temperature_2m"))).drop("is_public_holiday"))
    query("feat_train_lags")(_train_block(T.LAG_BLOCK))
    query("feat_train_interactions")(_train_block(T.INTERACTION_BLOCK))
    query("select_training_columns")(_train_block(T.TRAIN_COLUMNS[1:]))
    query("feat_serve_temporal")(_serve_block(S.TEMPORAL_BLOCK))
    query("feat_serve_weather")(serve_weather)
    query("feat_serve_lags")(_serve_block(S.LAG_BLOCK))
    query("feat_serve_interactions")(_serve_block(S.INTERACTION_BLOCK))


_register_blocks()


@query("season_of")
def q_season_of(spark, sf_dir):
    """both season maps over the multi-year daily series."""
    from gridcast.functions.calendar import season_serve, season_train
    d = B.daily_series(spark, sf_dir)
    return d.select("series_id", "ts", season_train(F.month("ts")).alias("season_train"),
                    season_serve(F.month("ts")).alias("season_serve"))


# --------------------------------------------------------------------------
# series windows
# --------------------------------------------------------------------------
def _hourly_pos(spark, sf_dir):
    from gridcast.operators.series import position_index
    return position_index(B.demand_hourly(spark, sf_dir).select("series_id", "ts", "actual_demand"),
                          "series_id", "ts")


@query("position_index")
def q_position_index(spark, sf_dir):
    """Dense 0..n-1 position per series."""
    return _hourly_pos(spark, sf_dir)


@query("lag_rows")
def q_lag_rows(spark, sf_dir):
    """Positional lags 1, 7, 24, 168 rows."""
    from gridcast.operators.series import lag_rows
    return lag_rows(_hourly_pos(spark, sf_dir), "actual_demand")


@query("lag_ffill_bfill")
def q_lag_ffill_bfill(spark, sf_dir):
    """Lags filled forward then backward."""
    from gridcast.operators.series import lag_rows
    return lag_rows(_hourly_pos(spark, sf_dir), "actual_demand", lags=(24, 168), fill="ffill_bfill")


@query("lag_fill_value")
def q_lag_fill_value(spark, sf_dir):
    """Lags filled with the frame mean."""
    from gridcast.operators.series import lag_rows
    x = _hourly_pos(spark, sf_dir)
    mu = x.groupBy("series_id").agg(F.avg("actual_demand").alias("_mu"))
    out = lag_rows(x.join(mu, "series_id"), "actual_demand", lags=(24, 168), fill="value",
                   fill_value=F.col("_mu"))
    return out.drop("_mu")


@query("seasonal_delta")
def q_seasonal_delta(spark, sf_dir):
    """X - x 24 rows earlier, ffill / bfill."""
    from gridcast.operators.series import seasonal_delta
    return seasonal_delta(_hourly_pos(spark, sf_dir), "actual_demand", 24)


@query("rolling_std_train")
def q_rolling_std_train(spark, sf_dir):
    """168-row rolling std (>= 24 obs), ffill / bfill, / frame std."""
    from gridcast.operators.series import rolling_std_train
    return rolling_std_train(_hourly_pos(spark, sf_dir), "actual_demand")


@query("rolling_std_serve")
def q_rolling_std_serve(spark, sf_dir):
    """168-row rolling std, missing -> frame std, / 10 000."""
    from gridcast.operators.series import rolling_std_serve
    return rolling_std_serve(_hourly_pos(spark, sf_dir), "actual_demand")


@query("day_transition")
def q_day_transition(spark, sf_dir):
    """Day-transition type from the weekday 24 rows earlier."""
    from gridcast.operators.series import day_transition
    return day_transition(_hourly_pos(spark, sf_dir), "ts")


@query("time_gaps")
def q_time_gaps(spark, sf_dir):
    """Gaps > 1 h to the previous row, 2 h flagged DST-like."""
    from gridcast.operators.series import time_gaps
    g = time_gaps(B.demand_hourly(spark, sf_dir))
    return (g.where(F.col("diff_seconds") > 3600)
            .withColumn("is_dst_like", F.col("diff_seconds") == 7200))


# The same operators over blocks of 200 rows (halo 168), so that lags, fills and
# windows cross many block borders even on the short series of the test tables.
SMALL_BLOCKS = 200


@query("features_train_small_blocks")
def q_features_train_small_blocks(spark, sf_dir):
    """F6 over many blocks."""
    return _train_frame(spark, sf_dir, block_rows=SMALL_BLOCKS)


@query("features_serve_small_blocks")
def q_features_serve_small_blocks(spark, sf_dir):
    """F11 over many blocks."""
    return _serve_frame(spark, sf_dir, block_rows=SMALL_BLOCKS)


@query("lag_ffill_bfill_small_blocks")
def q_lag_ffill_bfill_small_blocks(spark, sf_dir):
    """W3 over many blocks."""
    from gridcast.operators.series import lag_rows
    return lag_rows(_hourly_pos(spark, sf_dir), "actual_demand", lags=(24, 168), fill="ffill_bfill", block_rows=SMALL_BLOCKS)


@query("time_gaps_small_blocks")
def q_time_gaps_small_blocks(spark, sf_dir):
    """W8 over many blocks."""
    from gridcast.operators.series import time_gaps
    g = time_gaps(B.demand_hourly(spark, sf_dir), block_rows=SMALL_BLOCKS)
    return (g.where(F.col("diff_seconds") > 3600)
            .withColumn("is_dst_like", F.col("diff_seconds") == 7200))


@query("supervised_frame_small_blocks")
def q_supervised_frame_small_blocks(spark, sf_dir):
    """M2 over many blocks."""
    from gridcast.operators.ml import supervised_frame
    return supervised_frame(_train_pos(spark, sf_dir), ["temperature", "hour_sin", "is_weekend"], block_rows=SMALL_BLOCKS)


@query("explode_predictions_small_blocks")
def q_explode_predictions_small_blocks(spark, sf_dir):
    """M6 over many blocks."""
    from gridcast.operators.scoring import explode_predictions
    return explode_predictions(_train_pos(spark, sf_dir), block_rows=SMALL_BLOCKS)


@query("long_series_windows")
def q_long_series_windows(spark, sf_dir):
    """W2 / W7 on the multi-year daily series of lineitem: lags and the 168-row std over many blocks."""
    from gridcast.operators.series import block_window, core_only, positioned_blocks, rolling_std
    w = block_window("series_id", "pos")
    blk = positioned_blocks(B.large_daily_series(spark, sf_dir), "series_id", "ts", before=168, block_rows=512)
    blk = blk.select("*", *[F.lag("demand", k).over(w).alias(f"lag_{k}") for k in (1, 7, 168)])
    return core_only(rolling_std(blk, "demand", 168, 24, "std_168")).drop("_blk")


@query("sequence_windows")
def q_sequence_windows(spark, sf_dir):
    """48-row encoder / 24-row decoder target windows, stride 1."""
    from gridcast.operators.series import sequence_windows
    s = sequence_windows(_train_pos(spark, sf_dir), "target_demand", 48, 24, ts="timestamp")

    def txt(c):
        return F.array_join(F.transform(c, lambda v: F.round(v, 3).cast("decimal(20,3)").cast("string")), ",")
    return s.select("series_id", "origin_pos", "origin_ts", txt(F.col("encoder")).alias("encoder"),
                    txt(F.col("decoder")).alias("decoder"))


@query("tail_slice")
def q_tail_slice(spark, sf_dir):
    """Last encoder + horizon = 72 positions per series."""
    from gridcast.operators.series import tail_slice
    return tail_slice(_hourly_pos(spark, sf_dir), 72)


@query("chronological_split")
def q_chronological_split(spark, sf_dir):
    """Train / val / test label by int(n*0.8), int(n*0.9)."""
    from gridcast.operators.series import chronological_split, position_index
    tf = position_index(_train_frame(spark, sf_dir).select("series_id", "timestamp", "target_demand"),
                        "series_id", "timestamp")
    return chronological_split(tf)


# --------------------------------------------------------------------------
# scoring (M5, M6, G6-G18, J6-J8, M8-M10, F14)
# --------------------------------------------------------------------------
def _train_pos(spark, sf_dir):
    from gridcast.operators.series import position_index
    from gridcast.session import materialize
    return materialize(position_index(_train_frame(spark, sf_dir), "series_id", "timestamp"), "train-frame")


def _preds(spark, sf_dir):
    from gridcast.operators.scoring import explode_predictions
    return explode_predictions(_train_pos(spark, sf_dir))


@query("forecast_seasonal_naive")
def q_forecast_seasonal_naive(spark, sf_dir):
    """M5: value 24 and 168 rows earlier as forecasts."""
    from gridcast.operators.scoring import forecast_seasonal_naive
    return forecast_seasonal_naive(_hourly_pos(spark, sf_dir), "actual_demand")


@query("explode_predictions")
def q_explode_predictions(spark, sf_dir):
    """M6: long prediction frame over the test split."""
    return _preds(spark, sf_dir)


@query("score_overall", digits=4)
def q_score_overall(spark, sf_dir):
    """MAE, RMSE, bias."""
    from gridcast.operators.scoring import score_overall
    return score_overall(_preds(spark, sf_dir))


def _score_key(key, with_std=False):
    def fn(spark, sf_dir):
        from gridcast.operators.scoring import score_by
        return score_by(_preds(spark, sf_dir), key, with_std=with_std)
    return fn


query("score_by_hour")(_score_key("hour"))
query("score_by_month")(_score_key("month"))
query("score_by_week")(_score_key("week"))
query("score_by_horizon")(_score_key("horizon", with_std=True))


@query("score_by_dow")
def q_score_by_dow(spark, sf_dir):
    """Error by weekday over the full 0..6 domain."""
    from gridcast.operators.scoring import score_by_dow
    return score_by_dow(_preds(spark, sf_dir))


@query("complete_dow_domain")
def q_complete_dow_domain(spark, sf_dir):
    """Prediction rows per weekday 0..6 (zero when absent)."""
    from gridcast.operators.scoring import complete_dow_domain
    return complete_dow_domain(_preds(spark, sf_dir))


@query("pivot_mae", digits=4)
def q_pivot_mae(spark, sf_dir):
    """Hour x weekday mean absolute error."""
    from gridcast.operators.scoring import pivot_hour_dow
    return pivot_hour_dow(_preds(spark, sf_dir), "abs_error")


@query("pivot_bias", digits=4)
def q_pivot_bias(spark, sf_dir):
    """Hour x weekday mean error."""
    from gridcast.operators.scoring import pivot_hour_dow
    return pivot_hour_dow(_preds(spark, sf_dir), "error")


@query("bias_symmetric_range", digits=4)
def q_bias_symmetric_range(spark, sf_dir):
    """Symmetric colour range of the bias pivot."""
    from gridcast.operators.scoring import bias_symmetric_range
    return bias_symmetric_range(_preds(spark, sf_dir))


@query("best_worst_hour")
def q_best_worst_hour(spark, sf_dir):
    """Best / worst hour on the rounded hourly table."""
    from gridcast.operators.scoring import best_worst_hour, score_by
    return best_worst_hour(score_by(_preds(spark, sf_dir), "hour"))


@query("fit_bias_table", digits=4)
def q_fit_bias_table(spark, sf_dir):
    """M8: learned (hour, weekday) bias table per series."""
    from gridcast.operators.scoring import fit_bias_table
    return fit_bias_table(_preds(spark, sf_dir))


def _naive_forecast(spark, sf_dir):
    """Seasonal-naive forecasts of the test split as a forecast frame."""
    from gridcast.operators.scoring import forecast_seasonal_naive
    from gridcast.operators.series import chronological_split
    tp = _train_pos(spark, sf_dir).select("series_id", "pos", "timestamp", "target_demand")
    f = chronological_split(forecast_seasonal_naive(tp, "target_demand"))
    return f.where(F.col("split") == "test").select(
        "series_id", "timestamp", F.col("naive_24").alias("predicted_demand"))


@query("apply_bias", digits=4)
def q_apply_bias(spark, sf_dir):
    """Shipped (hour, weekday) correction applied to forecasts."""
    from gridcast.operators.scoring import apply_bias, shipped_bias_table
    return apply_bias(_naive_forecast(spark, sf_dir), shipped_bias_table(spark))


@query("forecast_range", digits=4)
def q_forecast_range(spark, sf_dir):
    """Raw and corrected forecast range."""
    from gridcast.operators.scoring import apply_bias, forecast_range, shipped_bias_table
    return forecast_range(apply_bias(_naive_forecast(spark, sf_dir), shipped_bias_table(spark)))


@query("score_report")
def q_score_report(spark, sf_dir):
    """Overall / hour / weekday / best / worst rows."""
    from gridcast.operators.scoring import score_report
    from gridcast.session import materialize
    return score_report(materialize(_preds(spark, sf_dir), "predictions"))


@query("join_predictions_features")
def q_join_predictions_features(spark, sf_dir):
    """Predictions LEFT feature frame on (series, timestamp)."""
    from gridcast.operators.joins import join_predictions_features
    feats = _train_frame(spark, sf_dir).select("series_id", "timestamp", "temperature", "is_weekend",
                                               "demand_lag_24h_norm")
    return join_predictions_features(_preds(spark, sf_dir), feats)


def _correlations(spark, sf_dir):
    from gridcast.operators.scoring import feature_correlations
    from gridcast.operators.series import chronological_split
    from gridcast.plans.train_features import TRAIN_FEATURES
    test = chronological_split(_train_pos(spark, sf_dir)).where(F.col("split") == "test")
    return feature_correlations(test, TRAIN_FEATURES)


@query("feature_correlations")
def q_feature_correlations(spark, sf_dir):
    """|r| and r of each training feature with the target, test slice."""
    return _correlations(spark, sf_dir)


@query("categorize_feature")
def q_categorize_feature(spark, sf_dir):
    """category of every feature name present in the scored frame."""
    from gridcast.operators.scoring import categorize_feature
    c = _correlations(spark, sf_dir)
    return c.select("series_id", "feature", categorize_feature(F.col("feature")).alias("category"))


@query("category_importance")
def q_category_importance(spark, sf_dir):
    """Importance roll-up by category (importance = |r| share)."""
    from gridcast.operators.scoring import category_importance, correlation_importance
    return category_importance(correlation_importance(_correlations(spark, sf_dir)))


@query("join_importance_correlation")
def q_join_importance_correlation(spark, sf_dir):
    """Importance LEFT correlation by feature."""
    from gridcast.operators.joins import join_importance_correlation
    from gridcast.operators.scoring import correlation_importance
    c = _correlations(spark, sf_dir)
    return join_importance_correlation(correlation_importance(c), c)


# --------------------------------------------------------------------------
# sources and sinks (A1-A19) -- landed files under the shared folder
# --------------------------------------------------------------------------
def _path(spark, name):
    from gridcast.session import shared_path
    return shared_path(spark, name)


def _landed_demand_csv(spark, sf_dir):
    from gridcast.sources.files import land_demand_csv
    p = _path(spark, "demand-csv")
    land_demand_csv(B.demand_raw(spark, sf_dir), p)
    return p


@query("scan_demand_csv")
def q_scan_demand_csv(spark, sf_dir):
    """A1: 15-minute demand CSV files -> typed rows."""
    from gridcast.sources.files import scan_demand_csv
    return scan_demand_csv(spark, _landed_demand_csv(spark, sf_dir))


@query("parse_interval_timestamp")
def q_parse_interval_timestamp(spark, sf_dir):
    """A3: MTU interval text -> start timestamp."""
    from gridcast.sources.files import parse_interval_timestamp
    raw = spark.read.option("header", True).csv(_landed_demand_csv(spark, sf_dir))
    return raw.select(F.col("`MTU (CET/CEST)`").alias("mtu"), parse_interval_timestamp("`MTU (CET/CEST)`").alias("ts"))


@query("scan_weather_csv")
def q_scan_weather_csv(spark, sf_dir):
    """A2: weather CSV files with metadata lines -> typed hourly rows."""
    from gridcast.sources.files import land_weather_csv, scan_weather_csv
    p = _path(spark, "weather-csv")
    land_weather_csv(B.weather_hourly(spark, sf_dir), p)
    return scan_weather_csv(spark, p)


@query("parse_multi_format_date")
def q_parse_multi_format_date(spark, sf_dir):
    """A4: four day-first formats (plus an invalid one) parsed back."""
    from gridcast.sources.files import parse_multi_format_date
    d = B.table(spark, sf_dir, "orders").select(F.col("o_orderdate").cast("timestamp_ntz").alias("d")).distinct()
    fmts = ["dd/MM/yyyy", "dd-MM-yyyy", "dd/MM/yyyy HH:mm:ss", "dd-MM-yyyy HH:mm:ss", "yyyy/MM/dd"]
    texts = d.select(F.explode(F.array(*[F.date_format("d", f) for f in fmts])).alias("text")).distinct()
    p = parse_multi_format_date("text")
    return texts.select("text", p.alias("parsed"), p.isNull().alias("invalid"))


def _offset_texts(spark, sf_dir):
    ev = B.table(spark, sf_dir, "events")
    return ev.select("event_id", F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+01:00")).alias("text"))


@query("normalize_utc")
def q_normalize_utc(spark, sf_dir):
    """A5: offset text -> UTC wall clock."""
    from gridcast.sources.files import normalize_utc
    t = _offset_texts(spark, sf_dir)
    return t.select("event_id", "text", normalize_utc("text").alias("ts"))


@query("normalize_wallclock")
def q_normalize_wallclock(spark, sf_dir):
    """Offset text -> local wall clock, offset dropped."""
    from gridcast.sources.files import normalize_wallclock
    t = _offset_texts(spark, sf_dir)
    return t.select("event_id", "text", normalize_wallclock("text").alias("ts"))


@query("flatten_holiday_json")
def q_flatten_holiday_json(spark, sf_dir):
    """Landed holiday JSON payloads (years of orders) -> holiday rows."""
    from gridcast.operators.calendar_ops import holiday_set_for
    from gridcast.sources.files import flatten_holiday_json, land_holiday_json
    p = _path(spark, "holidays-json")
    land_holiday_json(holiday_set_for(spark, B.daily_series(spark, sf_dir), "ts"), p)
    return flatten_holiday_json(spark, p)


@query("flatten_weather_arrays")
def q_flatten_weather_arrays(spark, sf_dir):
    """Landed weather array payloads -> hourly rows, incomplete hours dropped."""
    from gridcast.sources.files import flatten_weather_arrays, land_weather_json
    p = _path(spark, "weather-json")
    land_weather_json(B.weather_hourly(spark, sf_dir), p)
    return flatten_weather_arrays(spark, p)


@query("append_table")
def q_append_table(spark, sf_dir):
    """Two appends of the hourly demand, read back."""
    from gridcast.sources.files import append_table
    p = _path(spark, "append")
    d = B.demand_hourly(spark, sf_dir)
    append_table(d, p)
    append_table(d, p)
    return spark.read.parquet(p)


def _hourly_total(df):
    from gridcast.operators.resample import resample_hourly
    return resample_hourly(df.withColumn("series_id", F.lit("all")), values={"load": "actual_demand"}, dst=False)


def _revision_batch(spark, sf_dir):
    """First delivery as a day-partitioned hourly table, and a revision of some series that skips a day inside its range."""
    feed = B.demand_feed(spark, sf_dir)
    hourly = _hourly_by_series(feed.where("delivery = 0"))
    last = feed.select(F.max("series_id")).scalar()
    day = F.date_sub(F.to_date(feed.select(F.max("ts")).scalar()), 5)
    batch = feed.where("delivery = 1").where((F.col("series_id") < last) & (F.to_date("ts") != day))
    path = _path(spark, "replace-target")
    hourly.withColumn("day", F.to_date("ts")).write.partitionBy("day").parquet(path)
    return path, batch


def _hourly_by_series(df):
    from gridcast.operators.resample import resample_hourly
    return resample_hourly(df, values={"load": "actual_demand"}, dst=False)


@query("replace_range")
def q_replace_range(spark, sf_dir):
    """A10: a revised window replaces its key range per series in a day-partitioned table."""
    from gridcast.sources.files import current_table, replace_range
    path, batch = _revision_batch(spark, sf_dir)
    replace_range(spark, path, _hourly_by_series(batch))
    return current_table(spark, path).drop("day")


@query("replace_range_report")
def q_replace_range_report(spark, sf_dir):
    """A10: rows inserted and deleted by that replacement, and rows left."""
    from gridcast.sources.files import current_table, replace_range
    path, batch = _revision_batch(spark, sf_dir)
    report = replace_range(spark, path, _hourly_by_series(batch))
    return report.withColumn("rows_after", F.lit(current_table(spark, path).count()).cast("long"))


@query("feed_refresh")
def q_feed_refresh(spark, sf_dir):
    """Feed refresh: a re-fetched window through dedupe, hourly means, forecast join and DST into the demand table."""
    from gridcast.plans.feed_flow import hourly_feed, refresh_feed
    from gridcast.sources.files import current_table
    feed = B.demand_feed(spark, sf_dir)
    path = _path(spark, "feed-demand")
    hourly_feed(feed.where("delivery = 0")).withColumn("day", F.to_date("ts")).write.partitionBy("day").parquet(path)
    refresh_feed(spark, feed.where("delivery = 1"), path)
    return current_table(spark, path).drop("day")


@query("missing_years")
def q_missing_years(spark, sf_dir):
    """Of {last year, next year} of the data, the years the calendar lacks."""
    from gridcast.operators.calendar_ops import holiday_calendar, holiday_set_for, missing_years
    d = B.demand_hourly(spark, sf_dir)
    p = _path(spark, "calendar")
    holiday_calendar(spark, holiday_set_for(spark, d, "ts"), d, "ts").write.parquet(p)
    last = d.select(F.max(F.year("ts"))).first()[0]
    return missing_years(spark.read.parquet(p), "date", [last, last + 1])


@query("dedupe_keep_last")
def q_dedupe_keep_last(spark, sf_dir):
    """One row per (series, ts): the latest delivery."""
    from gridcast.operators.dedupe import dedupe_keep_last
    return dedupe_keep_last(B.demand_feed(spark, sf_dir), ["series_id", "ts"], ["delivery", "reading_id"])


@query("dedupe_keep_first")
def q_dedupe_keep_first(spark, sf_dir):
    """One row per (series, ts): the first delivery."""
    from gridcast.operators.dedupe import dedupe_keep_first
    return dedupe_keep_first(B.demand_feed(spark, sf_dir), ["series_id", "ts"], ["delivery", "reading_id"])


@query("zero_unavailability")
def q_zero_unavailability(spark, sf_dir):
    """Zero-filled unavailability rows per demand hour."""
    from gridcast.operators.dedupe import zero_unavailability
    return zero_unavailability(B.demand_hourly(spark, sf_dir))


@query("load_sources")
def q_load_sources(spark, sf_dir):
    """Demand, weather, public holidays loaded, renamed, joined."""
    return B.train_input(spark, sf_dir)


def _versioned_train(spark, sf_dir, times=1):
    from gridcast.sources.files import write_versioned
    tf = _train_frame(spark, sf_dir)
    base = _path(spark, "training-data")
    for _ in range(times):
        write_versioned(spark, tf, base)
    return base, tf.schema


@query("load_training_frame")
def q_load_training_frame(spark, sf_dir):
    """Newest versioned training file -> frame with time_idx."""
    from gridcast.sources.files import load_training_frame
    base, schema = _versioned_train(spark, sf_dir, times=2)
    return load_training_frame(spark, base, schema=schema)


@query("write_versioned")
def q_write_versioned(spark, sf_dir):
    """Three writes -> versions 1, 2, 3 with their row counts."""
    from gridcast.sources.files import list_versions
    base, schema = _versioned_train(spark, sf_dir, times=3)
    parts = [spark.read.schema(schema).option("header", True).csv(f"{base}/v={v}")
             .agg(F.lit(v).alias("version"), F.count(F.lit(1)).alias("rows")) for v in list_versions(spark, base)]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@query("write_results")
def q_write_results(spark, sf_dir):
    """Predictions written as CSV and read back."""
    from gridcast.sources.files import write_results
    preds = _preds(spark, sf_dir)
    p = _path(spark, "predictions-csv")
    write_results(preds, p)
    return spark.read.schema(preds.schema).option("header", True).csv(p)


@query("feed_summary")
def q_feed_summary(spark, sf_dir):
    """Rows, first/last timestamp, min/max demand and holidays of the covered years per series."""
    from gridcast.operators.calendar_ops import holiday_calendar, holiday_set_for
    from gridcast.sources.files import feed_summary
    d = B.demand_hourly(spark, sf_dir)
    calendar = holiday_calendar(spark, holiday_set_for(spark, d, "ts"), years_from=d, ts="ts")
    return feed_summary(d, "ts", "actual_demand", calendar=calendar)


# --------------------------------------------------------------------------
# calendar, spines, resampling, joins, dedupe probes
# --------------------------------------------------------------------------
@query("date_spine")
def q_date_spine(spark, sf_dir):
    """B1: every date of the years covered by orders."""
    from gridcast.operators.resample import date_spine
    return date_spine(B.daily_series(spark, sf_dir), "ts")


@query("hour_spine")
def q_hour_spine(spark, sf_dir):
    """B2: hourly spine over the events span."""
    from gridcast.operators.resample import hour_spine_of
    return hour_spine_of(B.table(spark, sf_dir, "events"), "ts")


@query("holiday_calendar")
def q_holiday_calendar(spark, sf_dir):
    """Date spine LEFT holidays for the years of the orders series."""
    from gridcast.operators.calendar_ops import holiday_calendar, holiday_set_for
    d = B.daily_series(spark, sf_dir)
    return holiday_calendar(spark, holiday_set_for(spark, d, "ts"), d, "ts")


@query("dst_flags_day25")
def q_dst_flags_day25(spark, sf_dir):
    """DST flags by the day-25 rule for every order date."""
    from gridcast.operators.calendar_ops import dst_frame_day25
    return dst_frame_day25(B.daily_series(spark, sf_dir).select("ts").distinct(), "ts")


@query("dst_flags_month")
def q_dst_flags_month(spark, sf_dir):
    """DST flags by the month rule for every order date."""
    from gridcast.operators.calendar_ops import dst_frame_month
    return dst_frame_month(B.daily_series(spark, sf_dir).select("ts").distinct(), "ts")


@query("resample_grid")
def q_resample_grid(spark, sf_dir):
    """Per-series regular hourly grid, empty hours NULL."""
    from gridcast.operators.resample import resample_grid
    return resample_grid(B.demand_hourly(spark, sf_dir).select("series_id", "ts", "actual_demand"))


@query("resample_drop_empty")
def q_resample_drop_empty(spark, sf_dir):
    """Grid with the empty hours dropped."""
    from gridcast.operators.resample import resample_drop_empty, resample_grid
    g = resample_grid(B.demand_hourly(spark, sf_dir).select("series_id", "ts", "actual_demand"))
    return resample_drop_empty(g, "actual_demand")


@query("duplicate_keys")
def q_duplicate_keys(spark, sf_dir):
    """First five duplicated (series, ts) keys of the feed, key order."""
    from gridcast.operators.dedupe import duplicate_keys
    return duplicate_keys(B.demand_feed(spark, sf_dir), ["series_id", "ts"], 5)


@query("series_stats")
def q_series_stats(spark, sf_dir):
    """Frame mean and sample std of demand and temperature per series."""
    from gridcast.operators.series import series_stats
    return series_stats(B.train_input(spark, sf_dir), cols=("demand", "temperature_2m"))


@query("join_demand_weather")
def q_join_demand_weather(spark, sf_dir):
    """Hourly demand x weather on the exact timestamp."""
    from gridcast.operators.joins import join_demand_weather
    return join_demand_weather(B.demand_hourly(spark, sf_dir).select("series_id", "ts", "actual_demand"),
                               B.weather_hourly(spark, sf_dir).select("ts", "temperature", "relative_humidity"))


@query("holiday_membership")
def q_holiday_membership(spark, sf_dir):
    """0/1 public-holiday flag on the multi-year daily series."""
    from gridcast.operators.calendar_ops import holiday_set_for
    from gridcast.operators.joins import holiday_membership
    d = B.daily_series(spark, sf_dir)
    return holiday_membership(d, holiday_set_for(spark, d, "ts"), ts="ts")


@query("join_serving_history")
def q_join_serving_history(spark, sf_dir):
    """Demand x weather, calendar left-joined, holiday flag coalesced."""
    return B.serve_input(spark, sf_dir)


@query("forecasting_view")
def q_forecasting_view(spark, sf_dir):
    """15-minute demand LEFT hourly weather LEFT calendar."""
    from gridcast.operators.calendar_ops import holiday_calendar, holiday_set_for
    from gridcast.operators.joins import forecasting_view
    from gridcast.sources.files import quarter_hour
    raw = B.demand_raw(spark, sf_dir)
    q = raw.groupBy("series_id", quarter_hour("ts").alias("ts")).agg(F.avg("load").alias("actual_demand"))
    d = B.demand_hourly(spark, sf_dir)
    cal = holiday_calendar(spark, holiday_set_for(spark, d, "ts"), d, "ts")
    return forecasting_view(q, B.weather_hourly(spark, sf_dir), cal)


@query("join_actual_forecast")
def q_join_actual_forecast(spark, sf_dir):
    """Actual LEFT day-ahead (previous day's value) forecast, missing -> 0."""
    from gridcast.operators.joins import join_actual_forecast
    d = B.demand_hourly(spark, sf_dir)
    actual = d.select("series_id", "ts", "actual_demand")
    fc = d.select("series_id", (F.col("ts") + F.expr("INTERVAL 24 HOURS")).alias("ts"),
                  F.col("actual_demand").alias("demand_forecast"))
    return join_actual_forecast(actual, fc)


@query("latest_n_asof")
def q_latest_n_asof(spark, sf_dir):
    """Latest 248 rows per series as of 20/01/2024 (rank-limited window)."""
    from gridcast.operators.series import latest_n_asof
    return latest_n_asof(B.serve_input(spark, sf_dir), "20/01/2024", 248)


@query("sort_by_time")
def q_sort_by_time(spark, sf_dir):
    """Hourly demand sorted by series and time (sort at the sink)."""
    return B.demand_hourly(spark, sf_dir).orderBy("series_id", "ts")


@query("drop_incomplete")
def q_drop_incomplete(spark, sf_dir):
    """Forecasting-view rows with any NULL dropped."""
    return q_forecasting_view(spark, sf_dir).na.drop("any")


# --------------------------------------------------------------------------
# validation (V1-V10, S7) and frame assembly
# --------------------------------------------------------------------------
def _readings(spark, sf_dir):
    return B.demand_feed(spark, sf_dir).select("series_id", "ts", "rid", "load", "forecast", "user_id")


def _pairs(spark, sf_dir):
    from gridcast.operators.validation import near_duplicate_pairs
    return near_duplicate_pairs(_readings(spark, sf_dir), "rid", "ts", ["load", "forecast", "user_id"],
                                series="series_id", target="load")


@query("near_duplicate_pairs")
def q_near_duplicate_pairs(spark, sf_dir):
    """Near-duplicate reading pairs within (series, floor hour)."""
    return _pairs(spark, sf_dir)


@query("near_duplicate_classes")
def q_near_duplicate_classes(spark, sf_dir):
    """Each reading with its class of equal readings of the hour, the class's size and the classes it is near to."""
    from gridcast.operators.validation import near_duplicate_classes
    members, links = near_duplicate_classes(_readings(spark, sf_dir), "rid", "ts", ["load", "forecast", "user_id"], series="series_id")
    ends = links.select("series_id", F.explode(F.array("class1", "class2")).alias("class_id"))
    near = ends.groupBy("series_id", "class_id").agg(F.count(F.lit(1)).alias("near_classes"))
    return members.join(near, ["series_id", "class_id"], "left").select(
        "series_id", "rid", "ts", "class_id", "class_rows", F.coalesce("near_classes", F.lit(0)).alias("near_classes"))


@query("near_duplicate_remove")
def q_near_duplicate_remove(spark, sf_dir):
    """V2: readings left after dropping every second member of a pair."""
    from gridcast.operators.validation import near_duplicate_remove
    return near_duplicate_remove(_readings(spark, sf_dir), "rid", "ts", ["load", "forecast", "user_id"], series="series_id")


def _validation_frame(spark, sf_dir):
    return B.validation_input(spark, sf_dir).withColumn("series_id", F.lit("all"))


@query("check_missing")
def q_check_missing(spark, sf_dir):
    """V3: NULLs per column of the per-series hourly grid."""
    from gridcast.operators.resample import resample_grid
    from gridcast.operators.validation import check_missing
    g = resample_grid(B.demand_hourly(spark, sf_dir).select("series_id", "ts", "actual_demand", "demand_forecast"))
    return check_missing(g, ["ts", "actual_demand", "demand_forecast"], "series_id")


@query("check_continuity")
def q_check_continuity(spark, sf_dir):
    """V4: gaps > 1 h (except 2 h) per series."""
    from gridcast.operators.validation import check_continuity
    return check_continuity(B.demand_hourly(spark, sf_dir))


@query("check_infinite")
def q_check_infinite(spark, sf_dir):
    """V5: infinite values per numeric column of the training frame."""
    from gridcast.operators.validation import check_infinite
    return check_infinite(_train_frame(spark, sf_dir), series="series_id")


@query("check_duplicate_ts")
def q_check_duplicate_ts(spark, sf_dir):
    """V6: timestamp uniqueness of the two-delivery feed per series."""
    from gridcast.operators.dedupe import duplicate_timestamps
    return duplicate_timestamps(B.demand_feed(spark, sf_dir), "series_id", "ts")


@query("check_ranges")
def q_check_ranges(spark, sf_dir):
    """V7: expected-range rules on total demand x weather."""
    from gridcast.operators.validation import check_ranges
    return check_ranges(_validation_frame(spark, sf_dir), series="series_id")


@query("check_leakage")
def q_check_leakage(spark, sf_dir):
    """V8: lag columns vs current columns of the serving frame."""
    from gridcast.operators.validation import LEAKAGE_PAIRS, check_leakage
    pairs = LEAKAGE_PAIRS + [("demand_lag_24h", "target_demand"), ("demand_lag_168h", "target_demand"),
                             ("temp_lag_24h", "temperature")]
    return check_leakage(_serve_frame(spark, sf_dir), pairs, "series_id")


@query("check_target_distribution")
def q_check_target_distribution(spark, sf_dir):
    """V9: target distribution and 3-sigma outliers."""
    from gridcast.operators.validation import check_target_distribution
    return check_target_distribution(_validation_frame(spark, sf_dir), "target_demand", "series_id")


@query("validation_report")
def q_validation_report(spark, sf_dir):
    """All checks on the total demand x weather frame."""
    from gridcast.operators.validation import validation_report
    return validation_report(_validation_frame(spark, sf_dir))


@query("validation_flow")
def q_validation_flow(spark, sf_dir):
    """Validation run: near duplicates removed, the rest saved, all checks and row counts reported."""
    from gridcast.plans.feed_flow import clean_and_report
    return clean_and_report(spark, _validation_frame(spark, sf_dir), _path(spark, "validated"), ["target_demand", "temperature", "humidity"])


@query("sample_issues")
def q_sample_issues(spark, sf_dir):
    """First gaps, repeated timestamps and near-duplicate pairs per series."""
    from gridcast.operators.dedupe import duplicate_keys
    from gridcast.operators.validation import check_continuity, sample_issues
    gaps = check_continuity(B.demand_hourly(spark, sf_dir))
    dups = duplicate_keys(B.demand_feed(spark, sf_dir), ["series_id", "ts"], None)
    return sample_issues(gaps, dups, _pairs(spark, sf_dir))


@query("concat_history_future")
def q_concat_history_future(spark, sf_dir):
    """S3: last 248 history rows + 24 future rows, one time_idx."""
    from gridcast.plans.future import concat_history_future, future_features
    hist = _serve_positions(spark, sf_dir)
    fut = future_features(hist, 24)
    c = concat_history_future(hist, fut, 248)
    return c.select("series_id", "time_idx", "timestamp", "target_demand", "temperature", "horizon")


@query("align_features")
def q_align_features(spark, sf_dir):
    """Serving frame aligned to the training feature list (absent -> 0.0)."""
    from gridcast.plans.future import align_features
    from gridcast.plans.train_features import TRAIN_FEATURES
    a = align_features(_serve_frame(spark, sf_dir), TRAIN_FEATURES)
    return a.select("series_id", "timestamp", *TRAIN_FEATURES)


# --------------------------------------------------------------------------
# forecasting on Spark ML (M1-M4, M7)
# --------------------------------------------------------------------------
@query("normalize_target")
def q_normalize_target(spark, sf_dir):
    """M1: per-series centre/scale of the inverse-softplus target, and inverse."""
    from gridcast.operators.ml import normalize_target
    return normalize_target(_train_frame(spark, sf_dir).select("series_id", "timestamp", "target_demand"))


@query("supervised_frame")
def q_supervised_frame(spark, sf_dir):
    """M2: direct-horizon rows (origin, horizon 1..24) with target-time features."""
    from gridcast.operators.ml import supervised_frame
    return supervised_frame(_train_pos(spark, sf_dir), ["temperature", "hour_sin", "is_weekend"])


def _fit(spark, sf_dir):
    """The forecaster on the train split of the serving frame, and the labelled frame."""
    from gridcast.operators.series import chronological_split
    from gridcast.plans.forecast_flow import fit_served
    from gridcast.session import materialize
    tf = materialize(chronological_split(_serve_frame(spark, sf_dir, keep_pos=True)), "serve-split")
    return fit_served(tf.where(F.col("split") == "train")), tf


@query("fit_forecaster", 2)
def q_fit_forecaster(spark, sf_dir):
    """M3: mean absolute error of the linear forecaster and of the value a day earlier, per split and series."""
    from gridcast.operators.ml import backtest
    from gridcast.plans.forecast_flow import FORECAST_FEATURES
    model, tf = _fit(spark, sf_dir)
    return backtest({"linear": model}, tf, FORECAST_FEATURES)


@query("forecast_backtest", 2)
def q_forecast_backtest(spark, sf_dir):
    """M3: errors of the boosted and the linear forecaster per split and series, and which the validation split chooses."""
    from gridcast.operators.ml import backtest, choose_forecaster, fit_boosted
    from gridcast.plans.forecast_flow import FORECAST_FEATURES
    linear, tf = _fit(spark, sf_dir)
    models = {"boosted": fit_boosted(tf.where(F.col("split") == "train"), FORECAST_FEATURES), "linear": linear}
    best, _ = choose_forecaster(models, tf.where(F.col("split") == "val"), FORECAST_FEATURES)
    return backtest(models, tf, FORECAST_FEATURES).withColumn("chosen", F.lit(best))


@query("feature_importance", 2)
def q_feature_importance(spark, sf_dir):
    """M7: growth of the linear forecaster's error on held-out rows when a feature is permuted, and its rank."""
    from gridcast.operators.ml import permutation_importance
    from gridcast.plans.forecast_flow import FORECAST_FEATURES
    model, tf = _fit(spark, sf_dir)
    rows = permutation_importance(model, tf.where(F.col("split") != "train"), FORECAST_FEATURES)
    return rows.select("feature", "importance")


@query("forecast", 4)
def q_forecast(spark, sf_dir):
    """M4: 48 h forecast per series from 20/01/2024, corrected by a table learned per series."""
    from gridcast.operators.scoring import explode_predictions, fit_bias_table
    from gridcast.plans.forecast_flow import FORECAST_FEATURES, forecast
    model, tf = _fit(spark, sf_dir)
    learned = fit_bias_table(explode_predictions(tf.select("series_id", "pos", "timestamp", "target_demand")))
    history = B.serve_input(spark, sf_dir)
    return forecast(spark, history, model, FORECAST_FEATURES, hours=48, forecast_from_date="20/01/2024", bias_table=learned)


# --------------------------------------------------------------------------
# streaming
# --------------------------------------------------------------------------
def _land(spark, df, name, deliveries=1):
    """Landed files, one per day, in deliveries one after the other; a delivery's files have no order."""
    p = _path(spark, name)
    days = df.withColumn("_day", F.to_date("ts"))
    span = days.agg(F.min("_day").alias("lo"), (F.datediff(F.max("_day"), F.min("_day")) + 1).alias("n")).first()
    for i in range(deliveries):
        turn = F.floor(F.datediff("_day", F.lit(span["lo"])) * deliveries / F.lit(span["n"])) == i
        days.where(turn).repartition("_day").sortWithinPartitions("ts").write.mode("append").partitionBy("_day").parquet(p)
    return p, df.schema


@query("stream_hourly_rollup")
def q_stream_hourly_rollup(spark, sf_dir):
    """Streaming hourly means per series over several micro-batches, closed by the watermark or open at the end."""
    from gridcast.streaming.feeds import stream_hourly_rollup
    src, schema = _land(spark, B.demand_raw(spark, sf_dir), "stream-readings", deliveries=3)
    return stream_hourly_rollup(spark, src, schema, _path(spark, "stream-rollup-out"))


@query("stream_dedupe")
def q_stream_dedupe(spark, sf_dir):
    """R2: streaming dedupe of the two-delivery feed on (series, ts), the least (delivery, reading) staying."""
    from gridcast.streaming.feeds import stream_dedupe
    feed = B.demand_feed(spark, sf_dir).select("series_id", "ts", "reading_id", "delivery")
    src, schema = _land(spark, feed, "stream-feed")
    return stream_dedupe(spark, src, schema, _path(spark, "stream-dedupe-out"), order=("delivery", "reading_id"))


@query("stream_replace_range")
def q_stream_replace_range(spark, sf_dir):
    """A streamed revision of some series upserted per series and day into the hourly table."""
    from gridcast.streaming.feeds import stream_replace_range
    target, batch = _revision_batch(spark, sf_dir)
    src, schema = _land(spark, batch.select("series_id", "ts", "load"), "stream-revisions")
    return stream_replace_range(spark, src, schema, target, prepare=_hourly_by_series).drop("day")


@query("profile_skew_audit")
def q_profile_skew_audit(spark, sf_dir):
    """D12 audit: for every column name the train and serve profiles share,
    how many rows differ and by how much on the same (series, timestamp)."""
    from gridcast.plans.serve_features import SERVE_COLUMNS
    from gridcast.plans.train_features import TRAIN_COLUMNS
    shared = [c for c in TRAIN_COLUMNS if c in SERVE_COLUMNS and c not in ("timestamp", "season")]
    t = _train_frame(spark, sf_dir, drop_incomplete=False).select(
        "series_id", "timestamp", *[F.col(c).cast("double").alias(f"t_{c}") for c in shared])
    s = _serve_frame(spark, sf_dir).select(
        "series_id", "timestamp", *[F.col(c).cast("double").alias(f"s_{c}") for c in shared])
    j = t.join(s, ["series_id", "timestamp"])
    aggs = [F.count(F.lit(1)).alias("_n")]
    for i, c in enumerate(shared):
        d = F.abs(F.col(f"t_{c}") - F.col(f"s_{c}"))
        aggs += [F.count(F.when(d > 1e-9, 1)).alias(f"_d{i}"), F.avg(d).alias(f"_m{i}")]
    wide = j.agg(*aggs)
    cells = F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"_d{i}").alias("differing"),
                               F.col(f"_m{i}").alias("mean_abs_diff")) for i, c in enumerate(shared)])
    return wide.select(F.col("_n").alias("rows"), F.inline(cells))
