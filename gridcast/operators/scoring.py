"""Forecast scoring and bias correction.

Everything runs on the long prediction frame (one row per origin x
horizon). Breakdowns are grouped aggregations; half-even rounding to 0
digits uses ``bround`` (numpy semantics). Lookup tables (bias 168 cells,
weekday domain 7 rows) are bounded by the calendar and broadcast.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridcast.operators.series import DEFAULT_BLOCK_ROWS, block_window, core_only, halo_blocks, join_stats, lag_rows

# The shipped bias table, MW by (hour, weekday Mon=0),
# rows are hours 0..23, columns weekdays 0..6.
SHIPPED_BIAS = [
    [84, -224, 26, 55, -308, -514, 251],
    [206, 89, 103, 177, -264, -307, 336],
    [122, 355, 150, 290, -236, -307, 118],
    [140, 359, 283, 214, -295, -394, 3],
    [-6, 434, 261, 252, -350, -361, -107],
    [290, 342, 246, 516, -141, 130, 82],
    [871, 225, 228, 108, -95, 514, 14],
    [60, 88, 370, -224, 90, 485, 50],
    [-782, 104, 290, -630, 157, 97, -27],
    [-216, 316, 142, -770, 123, -300, -348],
    [114, 228, 162, -1060, 269, -533, -712],
    [-1, 404, 154, -989, 576, -419, -784],
    [-24, 555, -58, -783, 246, -54, -548],
    [-172, 608, -129, -562, 621, 305, -121],
    [-218, 601, -244, -518, 662, 510, 156],
    [-306, 601, -510, -426, 568, 291, 305],
    [-619, 331, -602, -518, 240, -255, -56],
    [-1249, -15, -653, -814, 78, -947, -539],
    [-1385, 9, -674, -889, 167, -1093, -691],
    [-950, 172, -629, -759, 140, -618, -682],
    [-780, 308, -536, -509, 81, -206, -611],
    [-440, 460, -402, -483, -152, -240, -789],
    [-715, 498, -176, -337, -111, -205, -698],
    [-158, 498, 101, -326, -199, -69, -716],
]

# Feature-name categories, first matching rule wins.
CATEGORY_RULES = [
    ("Demand Lags", ["lag", "rolling"]),
    ("Weather", ["temp", "heat", "cold"]),
    ("Temporal", ["hour", "dow", "month", "day_", "weekend", "weekday", "holiday"]),
    ("Regime", ["regime"]),
    ("Interactions", ["interaction", "product"]),
]


def shipped_bias_table(spark: SparkSession) -> DataFrame:
    rows = [(h, d, float(v)) for h, row in enumerate(SHIPPED_BIAS) for d, v in enumerate(row)]
    return spark.createDataFrame(rows, "hour int, dow int, bias double")


def forecast_seasonal_naive(frame: DataFrame, value: str, series: str = "series_id",
                            pos: str = "pos") -> DataFrame:
    """Seasonal-naive forecasts: the value 24 and 168 rows earlier (M5)."""
    x = lag_rows(frame, value, lags=(24, 168), series=series, pos=pos)
    return (x.withColumnRenamed(f"{value}_lag_24", "naive_24")
            .withColumnRenamed(f"{value}_lag_168", "naive_168"))


def explode_predictions(frame: DataFrame, target: str = "target_demand", ts: str = "timestamp",
                        encoder: int = 48, horizon: int = 24, season: int = 24,
                        series: str = "series_id", pos: str = "pos",
                        train: float = 0.8, val: float = 0.1, predicted: str | None = None,
                        block_rows: int = DEFAULT_BLOCK_ROWS) -> DataFrame:
    """Long prediction frame on the test split (M6).

    ``predicted`` names the column of model predictions (per target row);
    without it the seasonal-naive value is scored.

    Origins are decoder starts s with a full encoder and decoder and
    s >= int(n*(train+val)); per horizon h the row's timestamp is
    ts[s] + (h-1) hours (positional rows, as in the reference).
    """
    n = frame.groupBy(series).agg(F.count(F.lit(1)).alias("_n"))
    if predicted:
        lagged, said = frame.select(series, pos, ts, target, predicted), predicted
    else:
        lagged, said = lag_rows(frame.select(series, pos, ts, target), target, lags=(season,), series=series, pos=pos), f"{target}_lag_{season}"
    blk = halo_blocks(lagged, pos, after=horizon - 1, block_rows=block_rows)
    rows = F.collect_list(F.struct(F.col(target).alias("actual"), F.col(said).alias("predicted"))).over(
        block_window(series, pos).rowsBetween(0, horizon - 1))
    x = join_stats(core_only(blk.select("*", rows.alias("_rows"))), n, series, pos)
    v_end = F.floor(F.col("_n").cast("double") * F.lit(train + val))
    origins = x.where((F.col(pos) >= encoder) & (F.size("_rows") == horizon) & (F.col(pos) >= v_end))
    j = origins.select(series, F.col(pos).alias("origin_pos"), F.col(ts).alias("_t0"), F.posexplode("_rows").alias("_h", "_r"))
    j = j.select(series, "origin_pos", "_t0", (F.col("_h") + 1).alias("horizon"), "_r.*")
    t = (F.col("_t0") + F.make_interval(hours=F.col("horizon") - 1)).cast("timestamp_ntz")
    j = j.select(series, "origin_pos", t.alias("timestamp"), "horizon", "predicted", "actual")
    err = F.col("predicted") - F.col("actual")
    return j.select(series, "origin_pos", "timestamp", F.hour("timestamp").alias("hour"),
                    F.weekday("timestamp").alias("dow"), F.month("timestamp").alias("month"),
                    F.weekofyear("timestamp").alias("week"), F.col("horizon").cast("int").alias("horizon"),
                    "predicted", "actual", err.alias("error"), F.abs(err).alias("abs_error"))


def score_overall(preds: DataFrame, series: str = "series_id") -> DataFrame:
    """MAE, RMSE, bias per series."""
    return preds.groupBy(series).agg(
        F.avg("abs_error").alias("mae"), F.sqrt(F.avg(F.col("error") * F.col("error"))).alias("rmse"),
        F.avg("error").alias("bias"), F.count(F.lit(1)).alias("n"))


def score_by(preds: DataFrame, key: str, series: str = "series_id", with_std: bool = False) -> DataFrame:
    """Mean abs error and mean error by a time key, half-even rounded."""
    aggs = [F.bround(F.avg("abs_error"), 0).alias("mae")]
    if with_std:
        aggs.append(F.bround(F.stddev_samp("abs_error"), 0).alias("std"))
    aggs.append(F.bround(F.avg("error"), 0).alias("bias"))
    return preds.groupBy(series, key).agg(*aggs)


def score_by_dow(preds: DataFrame, series: str = "series_id") -> DataFrame:
    """Error by weekday over the full 0..6 domain (G8 with J6).

    The seven-day domain is produced by one wide aggregation per series
    and an ``inline`` of seven structs -- no join against a domain table.
    """
    aggs = []
    for d in range(7):
        sel = F.col("dow") == d
        aggs += [F.avg(F.when(sel, F.col("abs_error"))).alias(f"_m{d}"),
                 F.avg(F.when(sel, F.col("error"))).alias(f"_b{d}")]
    wide = preds.groupBy(series).agg(*aggs)
    cells = F.array(*[F.struct(F.lit(d).alias("dow"), F.bround(F.col(f"_m{d}"), 0).alias("mae"),
                               F.bround(F.col(f"_b{d}"), 0).alias("bias")) for d in range(7)])
    return wide.select(series, F.inline(cells))


def complete_dow_domain(preds: DataFrame, series: str = "series_id") -> DataFrame:
    """Rows per weekday 0..6, zero for absent days."""
    wide = preds.groupBy(series).agg(*[F.count(F.when(F.col("dow") == d, 1)).alias(f"_c{d}") for d in range(7)])
    return wide.select(series, F.inline(F.array(*[
        F.struct(F.lit(d).alias("dow"), F.col(f"_c{d}").alias("rows")) for d in range(7)])))


def pivot_hour_dow(preds: DataFrame, value: str, series: str = "series_id") -> DataFrame:
    """hour x weekday pivot of the mean of a column."""
    p = preds.groupBy(series, "hour").pivot("dow", list(range(7))).agg(F.avg(value))
    return p.select(series, "hour", *[F.col(str(d)).alias(f"dow_{d}") for d in range(7)])


def bias_symmetric_range(preds: DataFrame, series: str = "series_id") -> DataFrame:
    """max(|min cell|, |max cell|) of the hour x weekday bias pivot."""
    cells = preds.groupBy(series, "hour", "dow").agg(F.avg("error").alias("_c"))
    return cells.groupBy(series).agg(
        F.greatest(F.abs(F.min("_c")), F.abs(F.max("_c"))).alias("max_abs_bias"))


def best_worst_hour(by_hour: DataFrame, series: str = "series_id") -> DataFrame:
    """Hour with the lowest / highest rounded MAE; ties -> earliest hour."""
    return by_hour.groupBy(series).agg(
        F.min_by("hour", F.struct("mae", "hour")).alias("best_hour"),
        F.min("mae").alias("best_mae"),
        F.max_by("hour", F.struct(F.col("mae"), (-F.col("hour")).alias("neg_hour"))).alias("worst_hour"),
        F.max("mae").alias("worst_mae"))


def fit_bias_table(preds: DataFrame, series: str = "series_id") -> DataFrame:
    """Learn the correction table: mean error per (hour, weekday) (M8)."""
    return preds.groupBy(series, "hour", "dow").agg(F.avg("error").alias("bias"),
                                                     F.count(F.lit(1)).alias("n"))


def apply_bias(forecast: DataFrame, table: DataFrame, ts: str = "timestamp",
               pred: str = "predicted_demand", keys=()) -> DataFrame:
    """correction = -bias(hour, weekday), default 0; corrected = predicted + correction (M9).

    A table with the series column is joined on it too. A global table is
    bounded (24 x 7 cells, more raise) and broadcast; a keyed one grows with
    the series count, so it is joined normally and AQE broadcasts it only if
    its runtime size allows.
    """
    keys = list(keys) or [c for c in ("series_id",) if c in table.columns and c in forecast.columns]
    if not keys and table.limit(24 * 7 + 1).count() > 24 * 7:
        raise ValueError("a table without a series has one cell per hour and weekday")
    t = table.select(*keys, F.col("hour").alias("_h"), F.col("dow").alias("_d"), F.col("bias").alias("_bias"))
    cond = [F.hour(F.col(ts)) == F.col("_h"), F.weekday(F.col(ts)) == F.col("_d")]
    cond += [forecast[k] == t[k] for k in keys]
    j = forecast.join(t if keys else F.broadcast(t), cond, "left")
    corr = (-F.coalesce(F.col("_bias"), F.lit(0.0))).alias("bias_correction")
    j = j.select(*[forecast[c] for c in forecast.columns], corr)
    return j.withColumn("corrected_demand", F.col(pred) + F.col("bias_correction"))


def forecast_range(corrected: DataFrame, series: str = "series_id") -> DataFrame:
    """Min / max of raw and corrected forecasts."""
    return corrected.groupBy(series).agg(
        F.min("predicted_demand").alias("raw_min"), F.max("predicted_demand").alias("raw_max"),
        F.min("corrected_demand").alias("corrected_min"), F.max("corrected_demand").alias("corrected_max"))


def categorize_feature(name: Column) -> Column:
    """Ordered substring rules -> category."""
    out = None
    for cat, needles in CATEGORY_RULES:
        cond = None
        for s in needles:
            c = name.contains(s)
            cond = c if cond is None else (cond | c)
        out = F.when(cond, cat) if out is None else out.when(cond, cat)
    return out.otherwise("Other")


def feature_correlations(frame: DataFrame, features, target: str = "target_demand",
                         series: str = "series_id") -> DataFrame:
    """Pearson r of every feature with the target per series.

    One wide aggregation (covar_pop, stddev_pop per feature) then a stack
    to long form; r is NULL when either side is constant.
    """
    y = F.col(target).cast("double")
    aggs = [F.stddev_pop(y).alias("_sy")]
    for i, f in enumerate(features):
        x = F.col(f).cast("double")
        aggs += [F.covar_pop(x, y).alias(f"_c{i}"), F.stddev_pop(x).alias(f"_s{i}")]
    wide = frame.groupBy(series).agg(*aggs)
    cells = F.array(*[F.struct(F.lit(f).alias("feature"),
                               F.try_divide(F.col(f"_c{i}"),
                                            F.when(F.col(f"_s{i}") * F.col("_sy") != 0,
                                                   F.col(f"_s{i}") * F.col("_sy"))).alias("correlation_raw"))
                      for i, f in enumerate(features)])
    long = wide.select(series, F.inline(cells))
    return long.select(series, "feature", F.abs("correlation_raw").alias("correlation"), "correlation_raw")


def correlation_importance(corr: DataFrame, series: str = "series_id") -> DataFrame:
    """Importance per feature = |r| share of the series total (data-derived)."""
    tot = corr.groupBy(series).agg(F.sum("correlation").alias("_tot"))
    return (corr.join(tot, series)
            .select(series, "feature", F.try_divide(F.col("correlation"), F.col("_tot")).alias("importance")))


def category_importance(importance: DataFrame, series: str = "series_id") -> DataFrame:
    """Sum, mean, count of importance per category, rounded to 4."""
    return (importance.withColumn("category", categorize_feature(F.col("feature")))
            .groupBy(series, "category")
            .agg(F.bround(F.sum("importance"), 4).alias("total_importance"),
                 F.bround(F.avg("importance"), 4).alias("avg_importance"),
                 F.count(F.lit(1)).alias("count")))


def score_report(preds: DataFrame, series: str = "series_id") -> DataFrame:
    """Overall, by hour, by weekday and best / worst hour as report rows.

    One aggregation of the predictions into (hour, weekday) sums; every section
    folds these few rows per series, by grouping sets.
    """
    error = F.col("error")
    cells = preds.groupBy(series, "hour", "dow").agg(
        F.count("error").alias("_n"), F.sum("abs_error").alias("_abs"), F.sum(error).alias("_err"), F.sum(error * error).alias("_sq"))

    def mean(total: str) -> Column:
        return F.bround(F.try_divide(F.sum(total), F.sum("_n")), 0)

    none = F.lit(None).cast("double")
    by_hour, by_dow = F.grouping("hour") == 0, F.grouping("dow") == 0
    rows = cells.groupingSets([[series], [series, "hour"], [series, "dow"]], series, "hour", "dow").agg(
        F.when(by_hour, "hour").when(by_dow, "dow").otherwise("overall").alias("section"), F.coalesce("hour", "dow").alias("item"),
        mean("_abs").alias("mae"), mean("_err").alias("bias"), F.when(by_hour | by_dow, none).otherwise(
            F.bround(F.sqrt(F.try_divide(F.sum("_sq"), F.sum("_n"))), 0)).alias("rmse"))
    rows = rows.where((F.col("section") != "dow") | F.col("mae").isNotNull()).select(series, "section", "item", "mae", "bias", "rmse")
    bw = best_worst_hour(rows.where("section = 'hour'").withColumnRenamed("item", "hour"), series)
    ends = F.array(*[F.struct(F.lit(f"{end}_hour").alias("section"), F.col(f"{end}_hour").alias("item"), F.col(f"{end}_mae").alias("mae"))
                     for end in ("best", "worst")])
    return rows.unionByName(bw.select(series, F.inline(ends)).select("*", none.alias("bias"), none.alias("rmse")))
