"""Scoring semantics: half-even rounding, weekday domain, ties, bias fit/apply."""

from pyspark.sql import functions as F

from gridcast.operators import scoring as SC


def _preds(spark, rows):
    df = spark.createDataFrame(rows, "series_id string, t string, horizon int, predicted double, actual double")
    ts = F.col("t").cast("timestamp_ntz")
    e = F.col("predicted") - F.col("actual")
    return df.select("series_id", ts.alias("timestamp"), F.hour(ts).alias("hour"), F.weekday(ts).alias("dow"),
                     F.month(ts).alias("month"), F.weekofyear(ts).alias("week"), "horizon", "predicted", "actual",
                     e.alias("error"), F.abs(e).alias("abs_error"))


def test_half_even_rounding(spark):
    rows = [("s", "2024-01-01 00:00:00", 1, 0.5, 0.0), ("s", "2024-01-01 01:00:00", 1, 1.5, 0.0),
            ("s", "2024-01-01 02:00:00", 1, 2.5, 0.0)]
    got = {r.hour: r.mae for r in SC.score_by(_preds(spark, rows), "hour").collect()}
    assert got == {0: 0.0, 1: 2.0, 2: 2.0}


def test_weekday_domain_complete(spark):
    rows = [("s", f"2024-01-0{d} 10:00:00", 1, 10.0, 0.0) for d in range(1, 6)]   # Mon..Fri
    out = SC.score_by_dow(_preds(spark, rows)).orderBy("dow").collect()
    assert [r.dow for r in out] == list(range(7))
    assert out[5].mae is None and out[6].mae is None and out[0].mae == 10.0


def test_best_worst_ties_first_hour(spark):
    rows = [("s", "2024-01-01 03:00:00", 1, 5.0, 0.0), ("s", "2024-01-01 01:00:00", 1, 5.0, 0.0),
            ("s", "2024-01-01 02:00:00", 1, 9.0, 0.0), ("s", "2024-01-01 04:00:00", 1, 9.0, 0.0)]
    bw = SC.best_worst_hour(SC.score_by(_preds(spark, rows), "hour")).first()
    assert (bw.best_hour, bw.best_mae, bw.worst_hour, bw.worst_mae) == (1, 5.0, 2, 9.0)


def test_fit_then_apply_bias_zeroes_cells(spark):
    rows = [("s", f"2024-01-{d:02d} {h:02d}:00:00", 1, 100.0 + h * d, 90.0) for d in range(1, 15) for h in (0, 7, 18)]
    p = _preds(spark, rows)
    table = SC.fit_bias_table(p)
    fc = p.select("series_id", "timestamp", F.col("predicted").alias("predicted_demand"), "actual")
    out = SC.apply_bias(fc, table, keys=("series_id",))
    err = out.groupBy(F.hour("timestamp"), F.weekday("timestamp")).agg(
        F.avg(F.col("corrected_demand") - F.col("actual")).alias("e")).collect()
    assert all(abs(r.e) < 1e-9 for r in err)


def test_shipped_table_and_default(spark):
    t = SC.shipped_bias_table(spark)
    assert t.count() == 168
    assert t.agg(F.min("bias"), F.max("bias")).first() == (-1385.0, 871.0)
    fc = spark.createDataFrame([("2024-01-01 18:00:00", 50000.0)], "t string, predicted_demand double").select(
        F.col("t").cast("timestamp_ntz").alias("timestamp"), "predicted_demand")
    r = SC.apply_bias(fc, t).first()
    assert r.bias_correction == 1385.0 and r.corrected_demand == 51385.0     # Monday 18:00


def test_categories(spark):
    names = ["demand_lag_24h_norm", "temp_severity", "hour_sin", "regime_0", "peak_heating_interaction",
             "heating_hour_cos_product", "target"]
    df = spark.createDataFrame([(n,) for n in names], "feature string")
    got = {r.feature: r.c for r in df.select("feature", SC.categorize_feature(F.col("feature")).alias("c")).collect()}
    assert got == {"demand_lag_24h_norm": "Demand Lags", "temp_severity": "Weather", "hour_sin": "Temporal",
                   "regime_0": "Regime", "peak_heating_interaction": "Weather",
                   "heating_hour_cos_product": "Weather", "target": "Other"}
