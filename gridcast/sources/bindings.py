"""Bind the driver's read-only test tables to the canonical tables.

Every canonical table is *derived by Spark* from the given parquet files,
so all work grows with them:

* ``demand_raw``   events -> one reading per event: series = event_type,
  load = value x 1000, day-ahead forecast reading = props.k x 1000.
* ``demand_feed``  demand_raw plus a second delivery of the trailing
  revision window (a re-fetch, as the feeds re-fetch their last days)
  carrying revised loads and a later delivery number.
* ``demand_hourly`` hourly means per series (gappy at small scale).
* ``demand_total``  hourly mean over all series, series_id = 'all'.
* ``weather_hourly`` per hour over all events from props.k.
* ``daily_series`` / ``large_daily_series`` multi-year daily series from
  orders / lineitem.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridcast.functions.calendar import dst_flags_day25, hour_floor

# Fixed values of the bindings (shared with the oracle SQL).
REVISION_DAYS = 10          # length of the re-delivered trailing window
REVISION_FACTOR = 1.0004    # revised load = load x factor
LOAD_SCALE = 1000.0         # value -> MW


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _k(props="props"):
    return F.get_json_object(F.col(props), "$.k").cast("int")


def demand_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events")
    return ev.select(
        F.col("event_type").alias("series_id"),
        F.col("ts").cast("timestamp_ntz").alias("ts"),
        F.col("event_id").alias("reading_id"),
        (F.col("value") * F.lit(LOAD_SCALE)).alias("load"),
        (_k().cast("double") * F.lit(LOAD_SCALE)).alias("forecast"),
        _k().alias("k"),
        F.col("user_id"),
    )


def demand_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two deliveries: everything (0) and a revised trailing window (1)."""
    raw = demand_raw(spark, sf_dir)
    last_ts = raw.select(F.max("ts")).scalar()
    first = raw.withColumn("delivery", F.lit(0))
    revised = (raw.where(F.col("ts") >= last_ts - F.expr(f"INTERVAL {REVISION_DAYS} DAYS"))
               .withColumn("load", F.col("load") * F.lit(REVISION_FACTOR))
               .withColumn("delivery", F.lit(1)))
    out = first.unionByName(revised)
    return out.withColumn("rid", (F.col("reading_id") * 2 + F.col("delivery")).cast("long"))


def demand_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    from gridcast.operators.resample import resample_hourly
    return resample_hourly(demand_raw(spark, sf_dir), values={"load": "actual_demand",
                                                               "forecast": "demand_forecast"})


def demand_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = demand_raw(spark, sf_dir).withColumn("series_id", F.lit("all"))
    from gridcast.operators.resample import resample_hourly
    return resample_hourly(raw, values={"load": "actual_demand", "forecast": "demand_forecast"})


def weather_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events")
    k = _k()
    h = hour_floor("ts").alias("ts")
    w = ev.groupBy(h).agg(
        (F.avg(k) * F.lit(0.6) - F.lit(20.0)).alias("temperature"),
        F.max(k).cast("double").alias("relative_humidity"),
        (F.min(k) / F.lit(10.0)).alias("rain"),
        F.lit(0.0).alias("snow_depth"),
        (F.count(F.lit(1)) % 3).cast("double").alias("snowfall"),
    )
    return w.select("*", *dst_flags_day25("ts"))


def daily_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    return (o.groupBy(F.col("o_orderpriority").alias("series_id"),
                      F.col("o_orderdate").cast("timestamp_ntz").alias("ts"))
            .agg(F.avg("o_totalprice").alias("demand")))


def large_daily_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    return (li.groupBy(F.concat("l_returnflag", "l_linestatus").alias("series_id"),
                       F.col("l_shipdate").cast("timestamp_ntz").alias("ts"))
            .agg(F.avg("l_extendedprice").alias("demand")))


def hourly_inputs(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """demand_hourly and weather_hourly from one scan of the readings.

    Partial aggregates per (series, hour) are written once; both tables and
    the years they cover come from that small table.
    """
    from gridcast.session import materialize
    hour = hour_floor("ts").alias("ts")
    parts = materialize(demand_raw(spark, sf_dir).groupBy("series_id", hour).agg(
        F.avg("load").alias("actual_demand"), F.avg("forecast").alias("demand_forecast"), F.sum("k").alias("k_sum"),
        F.count("k").alias("k_count"), F.min("k").alias("k_min"), F.max("k").alias("k_max"), F.count(F.lit(1)).alias("n")), "hourly-parts")
    demand = parts.select("series_id", "ts", "actual_demand", "demand_forecast", *dst_flags_day25("ts"))
    weather = parts.groupBy("ts").agg(
        (F.try_divide(F.sum("k_sum"), F.sum("k_count")) * F.lit(0.6) - F.lit(20.0)).alias("temperature"),
        F.max("k_max").cast("double").alias("relative_humidity"), (F.min("k_min") / F.lit(10.0)).alias("rain"),
        F.lit(0.0).alias("snow_depth"), (F.sum("n") % 3).cast("double").alias("snowfall"))
    return demand, weather.select("*", *dst_flags_day25("ts"))


def train_input(spark: SparkSession, sf_dir: str) -> DataFrame:
    """demand_hourly x weather x public holidays: the training-frame load."""
    from gridcast.operators.joins import join_demand_weather, holiday_membership
    from gridcast.operators.calendar_ops import holiday_set_for
    d, w = hourly_inputs(spark, sf_dir)
    d = d.select("series_id", F.col("ts").alias("timestamp"), F.col("actual_demand").alias("demand"))
    w = w.select(F.col("ts").alias("timestamp"), F.col("temperature").alias("temperature_2m"))
    j = join_demand_weather(d, w, on="timestamp")
    hol = holiday_set_for(spark, d, "timestamp")
    return holiday_membership(j, hol, ts="timestamp")


def serve_input(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The serving history: demand x weather, holidays left-joined."""
    from gridcast.operators.joins import join_serving_history
    from gridcast.operators.calendar_ops import holiday_calendar, holiday_set_for
    d, w = hourly_inputs(spark, sf_dir)
    cal = holiday_calendar(spark, holiday_set_for(spark, d, "ts"), years_from=d, ts="ts")
    return join_serving_history(d, w, cal)


def validation_input(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Total demand x weather: the frame the range/distribution checks read."""
    d = demand_total(spark, sf_dir).select(F.col("ts").alias("timestamp"),
                                           F.col("actual_demand").alias("target_demand"))
    w = weather_hourly(spark, sf_dir).select(F.col("ts").alias("timestamp"), "temperature",
                                             F.col("relative_humidity").alias("humidity"))
    return d.join(w, "timestamp", "inner")
