"""Calendar rules, payload flattening, parsing, sinks."""

import json
import os

import itertools

import pytest
from pyspark.sql import functions as F

from gridcast.functions.calendar import dst_flags_day25, dst_flags_month
from gridcast.operators.calendar_ops import flatten_holidays, holiday_calendar
from gridcast.session import shared_path
from gridcast.sources import files as FS


def test_dst_day25_vs_month(spark):
    days = ["2024-03-24", "2024-03-25", "2024-03-26", "2024-10-24", "2024-10-25", "2024-10-26"]
    df = spark.createDataFrame([(d,) for d in days], "d string").select(F.col("d").cast("date").alias("d"))
    r = df.select("d", *dst_flags_day25("d"), *dst_flags_month("d", "mw", "ms")).orderBy("d").collect()
    assert [x.daylight_savings_summer for x in r] == [False, True, True, True, False, False]
    assert [x.ms for x in r] == [0, 0, 0, 1, 1, 1]


def test_holiday_payload_rules(spark):
    payload = [
        {"date": "2024-01-01", "global": True, "types": ["Public"], "counties": None},
        {"date": "2024-01-06", "types": None, "counties": ["DE-BW", "DE-BY"]},
        {"date": "2024-05-30", "global": False, "types": ["Optional", "Public"], "counties": None},
        {"date": "2024-05-30", "global": True, "types": ["Bank"], "counties": ["DE-BY"]},
    ]
    p = shared_path(spark, "t-hol")
    spark.sparkContext.parallelize([json.dumps(payload)], 1).saveAsTextFile(p)
    rows = {(r.date.isoformat(), r.holiday_type): r for r in FS.flatten_holiday_json(spark, p).collect()}
    assert rows[("2024-01-06", None)].is_public_holiday is False
    assert rows[("2024-01-06", None)].is_national is False and rows[("2024-01-06", None)].counties_affected == 2
    assert rows[("2024-01-01", "Public")].counties_affected == 0
    # two entries on one date collapse to one calendar row
    raw = spark.read.schema("date string, global boolean, types array<string>, counties array<string>") \
        .option("multiLine", True).json(p).withColumn("ordinal", F.monotonically_increasing_id())
    years = spark.createDataFrame([("2024-06-01",)], "t string").select(F.col("t").cast("timestamp_ntz").alias("ts"))
    cal = holiday_calendar(spark, raw, years, "ts")
    assert cal.count() == 366
    d = cal.where("date = '2024-05-30'").collect()
    assert len(d) == 1 and d[0].is_public_holiday and d[0].is_national and d[0].holiday_type == "Optional"
    assert cal.where("date = '2024-02-01'").first().holiday_type == ""


def test_date_texts(spark):
    texts = ["20/01/2024", "20-01-2024", "20/01/2024 10:30:00", "20-01-2024 10:30:00", "2024-01-20", "32/01/2024"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r.p for r in df.select(FS.parse_multi_format_date("t").alias("p")).collect()]
    assert [g is None for g in got] == [False, False, False, False, True, True]
    assert str(got[2]) == "2024-01-20 10:30:00"


def test_interval_and_quarter_hours(spark):
    df = spark.createDataFrame([("25/10/2020 02:00 - 25/10/2020 02:15 (CET)",), ("01/01/2024 23:45 - 02/01/2024 00:00",)], "m string")
    got = [str(r.t) for r in df.select(FS.parse_interval_timestamp("m").alias("t")).collect()]
    assert got == ["2020-10-25 02:00:00", "2024-01-01 23:45:00"]


def test_dst_repeat_hour_mean(spark):
    from gridcast.operators.resample import resample_hourly
    # 8 quarter-hours of one repeated local hour (zone text stripped) -> one bucket
    rows = [("s", f"2020-10-25 02:{m:02d}:00", float(v)) for v, m in enumerate([0, 15, 30, 45, 0, 15, 30, 45])]
    df = spark.createDataFrame(rows, "series_id string, t string, load double").select(
        "series_id", F.col("t").cast("timestamp_ntz").alias("ts"), "load")
    r = resample_hourly(df).collect()
    assert len(r) == 1 and r[0].actual_demand == 3.5 and r[0].daylight_savings_winter is True


def test_replace_range_counts_and_idempotence(spark):
    base = spark.range(10).select(F.lit("all").alias("series_id"),
                                  (F.lit("2024-01-01").cast("timestamp_ntz") + F.make_interval(hours=F.col("id").cast("int")))
                                  .alias("ts"), F.col("id").cast("double").alias("v"))
    p = shared_path(spark, "t-replace")
    base.withColumn("day", F.to_date("ts")).write.partitionBy("day").parquet(p)
    batch = base.where("v >= 3 and v <= 6").withColumn("v", F.col("v") + 100)
    r = FS.replace_range(spark, p, batch).first()
    assert (r.inserted, r.deleted) == (4, 4)
    first = sorted((str(x.ts), x.v) for x in FS.current_table(spark, p).collect())
    r2 = FS.replace_range(spark, p, batch).first()
    assert (r2.inserted, r2.deleted) == (4, 4)
    assert sorted((str(x.ts), x.v) for x in FS.current_table(spark, p).collect()) == first
    assert len(first) == 10 and sum(v for _, v in first) == 45 + 400
    empty = FS.replace_range(spark, p, batch.where("false")).first()
    assert (empty.inserted, empty.deleted) == (0, 0)


def test_versions_numeric_order(spark):
    base = shared_path(spark, "t-versions")
    df = spark.range(3).select(F.col("id").alias("x"), F.lit("2024-01-01 00:00:00").alias("timestamp"),
                               F.lit("winter").alias("season"), F.lit("s").alias("series_id"))
    for _ in range(10):
        FS.write_versioned(spark, df, base)
    assert FS.list_versions(spark, base) == list(range(1, 11))
    assert FS.write_versioned(spark, df, base) == 11


def test_year_regimes(spark):
    from gridcast.plans.serve_features import calendar_columns
    df = spark.createDataFrame([(f"{y}-06-01 12:00:00",) for y in range(2018, 2026)], "t string").select(
        F.col("t").cast("timestamp_ntz").alias("ts"))
    r = df.select("ts", *calendar_columns("ts")).orderBy("ts").collect()
    reg = [(x.regime_0, x.regime_1, x.regime_2, x.regime_3) for x in r]
    assert reg[0] == (0.0, 0.0, 0.0, 0.0)
    assert reg[1] == (1.0, 0.0, 0.0, 0.0) and reg[2] == (0.0, 1.0, 0.0, 0.0)
    assert reg[3] == reg[4] == (0.0, 0.0, 1.0, 0.0) and reg[5] == reg[7] == (0.0, 0.0, 0.0, 1.0)


def test_staged_tables_are_dropped(spark):
    from gridcast.session import _STAGED, drop_staged, materialize
    _STAGED.clear()
    df = materialize(spark.range(5), "t-stage")
    p = _STAGED[-1]
    assert df.count() == 5 and os.path.exists(p.replace("file:", ""))
    assert drop_staged(spark) == 1 and not os.path.exists(p.replace("file:", ""))


def test_a_stopped_replacement_leaves_the_table_whole(spark, monkeypatch):
    hours = [f"2024-01-0{d} {h:02d}:00:00" for d in (1, 2, 3, 4) for h in range(0, 24, 6)]
    base = spark.createDataFrame([(s, t, 1.0) for s in "ab" for t in hours], "series_id string, t string, v double").select(
        "series_id", F.col("t").cast("timestamp_ntz").alias("ts"), "v")
    p = shared_path(spark, "t-atomic")
    base.withColumn("day", F.to_date("ts")).write.partitionBy("day").parquet(p)

    def rows():
        return sorted((r.series_id, str(r.ts), r.v) for r in FS.current_table(spark, p).collect())

    before = rows()
    batch = base.where("series_id = 'a' and day(ts) in (2, 3)").withColumn("v", F.lit(2.0))

    def stop(*_):
        raise RuntimeError("stopped")

    for again in range(2):  # on a plain table, then on a versioned one
        held = rows()
        with monkeypatch.context() as m:
            m.setattr(FS, "_switch", stop)
            with pytest.raises(RuntimeError):
                FS.replace_range(spark, p, batch)
        assert rows() == held  # the data were written, the switch was not
        (spark.createDataFrame([("x", "y")], "day string, dir string").write.parquet(f"{p}/_versions/v={again + 1}"))
        FS._delete(spark, f"{p}/_versions/v={again + 1}/_SUCCESS")  # a version begun, not completed
        assert rows() == held
        assert tuple(FS.replace_range(spark, p, batch).first()) == (8, 8)
        want = sorted((s, t, 2.0 if s == "a" and "-02 " in t or s == "a" and "-03 " in t else v) for s, t, v in before)
        assert rows() == want
    dirs = FS._day_dirs(spark, p, "day")
    assert dirs["2024-01-01"] == dirs["2024-01-04"] == p and dirs["2024-01-02"] != p  # untouched days stay where they are
    assert FS.drop_replaced(spark, p) > 0 and rows() == want


def _csv(spark, path, texts):
    for i, lines in enumerate(texts):
        spark.createDataFrame([("\n".join(lines),)], "value string").coalesce(1).write.text(f"{path}/f{i:03d}")


def test_csv_layouts_of_any_number(spark):
    names = ["MTU (CET)", FS.DEMAND_ACTUAL, FS.DEMAND_FORECAST] + [f"extra {i}" for i in range(4)]
    path = shared_path(spark, "t-layouts")
    orders = list(itertools.permutations(range(6)))[:200]
    rows = []
    for k, order in enumerate(orders):
        cell = {0: "01/01/2024 00:15 - 01/01/2024 00:30", 1: str(k), 2: f'"{k + 1000}"', 3: "x", 4: '"a,b"', 5: ""}
        rows += [(f"{k:03d}", 0, ",".join(names[i] for i in order)), (f"{k:03d}", 1, ",".join(cell[i] for i in order)),
                 (f"{k:03d}", 2, ",".join("n/e" if i == 1 else cell[i] for i in order))]
    df = spark.createDataFrame(rows, "f string, k int, value string")
    df.repartition("f").sortWithinPartitions("f", "k").select("f", "value").write.partitionBy("f").text(path)
    got = FS.scan_demand_csv(spark, path).collect()
    assert sorted((r.actual_load, r.forecast_load) for r in got if r.actual_load is not None) == [(float(k), float(k + 1000)) for k in range(200)]
    assert sum(r.actual_load is None for r in got) == 200 and {str(r.ts) for r in got} == {"2024-01-01 00:15:00"}


def test_csv_headers_that_do_not_fit(spark):
    head = f"Time,{FS.DEMAND_ACTUAL},{FS.DEMAND_FORECAST}"
    for k, (texts, said) in enumerate(((["a,b", "c,d"], "no header"), ([f"Time,{FS.DEMAND_ACTUAL}"], "header without"),
                                       ([head, f"MTU,{FS.DEMAND_ACTUAL},{FS.DEMAND_FORECAST}"], "different"))):
        path = shared_path(spark, f"t-heads{k}")
        _csv(spark, path, [texts])
        with pytest.raises(ValueError, match=said):
            FS.scan_demand_csv(spark, f"{path}/f000")
    path = shared_path(spark, "t-one")
    _csv(spark, path, [[head, "01/01/2024 00:15,1,2"], ["01/01/2024 00:30,3,4"]])  # a file without a header, one layout
    assert FS.scan_demand_csv(spark, f"{path}/*").count() == 2
