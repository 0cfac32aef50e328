"""Streaming equals batch, however files fall into micro-batches."""

import random

import pytest
from pyspark.sql import functions as F

from gridcast.operators.resample import resample_hourly
from gridcast.session import shared_path
from gridcast.sources import bindings as B
from gridcast.sources.files import current_table, replace_range
from gridcast.streaming.feeds import late_readings, stream_dedupe, stream_hourly_rollup, stream_replace_range

SF = "/root/testdata/sf0.001"


def _land(spark, df, name, shuffled):
    """A few files, in day order or with days mixed and out of order."""
    src = shared_path(spark, name)
    days = [r[0] for r in df.select(F.to_date("ts")).distinct().orderBy(F.to_date("ts")).collect()][:6]
    df = df.where(F.to_date("ts").isin(days))
    if shuffled:
        random.Random(1).shuffle(days)
    for pair in zip(days[::2], days[1::2]):
        df.where(F.to_date("ts").isin(list(pair))).coalesce(1).write.mode("append").parquet(src)
    return src, df


@pytest.mark.parametrize("shuffled", [False, True])
def test_rollup_stream_equals_batch(spark, shuffled):
    src, raw = _land(spark, B.demand_raw(spark, SF), "t-stream-src", shuffled)
    out = stream_hourly_rollup(spark, src, raw.schema, shared_path(spark, "t-stream-out"), max_files=1)
    batch = resample_hourly(raw, dst=False)
    rows = lambda d: sorted((r.series_id, r.ts, round(r.actual_demand, 6)) for r in d.collect())
    assert rows(out) == rows(batch) and batch.count() > 50


@pytest.mark.parametrize("shuffled", [False, True])
def test_dedupe_stream_keeps_one_row_per_key(spark, shuffled):
    feed = B.demand_feed(spark, SF).select("series_id", "ts", "reading_id", "delivery")
    last = feed.agg(F.max(F.to_date("ts"))).first()[0]
    feed = feed.where(F.to_date("ts") > F.date_sub(F.lit(last), 6))
    src, feed = _land(spark, feed, "t-stream-feed", shuffled)
    out = stream_dedupe(spark, src, feed.schema, shared_path(spark, "t-stream-dd"), order=("delivery", "reading_id"), max_files=1)
    assert out.count() == feed.select("series_id", "ts").distinct().count() < feed.count()
    assert out.where("delivery <> 0").isEmpty()


def _readings(spark, rows):
    df = spark.createDataFrame(rows, "series_id string, at string, reading_id long, load double")
    return df.select("series_id", F.col("at").cast("timestamp_ntz").alias("ts"), "reading_id", "load")


def _append(spark, src, rows):
    _readings(spark, rows).coalesce(1).write.mode("append").parquet(src)


def test_rollup_closes_hours_and_counts_late_readings(spark):
    src, sink = shared_path(spark, "t-late"), shared_path(spark, "t-late-out")
    schema = _readings(spark, []).schema

    def run(**options):
        out = stream_hourly_rollup(spark, src, schema, sink, lateness="2 hours", max_files=1, **options)
        return {(r.series_id, r.ts.hour): r.actual_demand for r in out.collect()}

    _append(spark, src, [("a", "2024-01-01 00:10:00", 1, 10.0), ("a", "2024-01-01 00:40:00", 2, 20.0), ("b", "2024-01-01 01:00:00", 3, 7.0)])
    _append(spark, src, [("a", "2024-01-01 03:30:00", 4, 1.0)])  # closes the hours that end by 01:30
    _append(spark, src, [("a", "2024-01-01 00:50:00", 5, 999.0),  # too late: hour 0 is closed
                         ("a", "2024-01-01 01:30:00", 6, 5.0)])  # late, but hour 1 is open
    assert run(flush=False) == {("a", 0): 15.0}
    assert [(r.series_id, r.ts.hour, r.n, r.total) for r in late_readings(spark, sink).collect()] == [("a", 0, 1, 999.0)]
    assert run() == {("a", 0): 15.0, ("a", 1): 5.0, ("b", 1): 7.0, ("a", 3): 1.0}
    # a later run goes on from the state: open hours take more readings and close once
    _append(spark, src, [("a", "2024-01-01 03:45:00", 7, 3.0), ("b", "2024-01-01 01:59:59", 8, 9.0)])
    _append(spark, src, [("a", "2024-01-01 09:00:00", 9, 4.0)])
    assert run(flush=False) == {("a", 0): 15.0, ("a", 1): 5.0, ("b", 1): 8.0, ("a", 3): 2.0}
    assert run() == {("a", 0): 15.0, ("a", 1): 5.0, ("b", 1): 8.0, ("a", 3): 2.0, ("a", 9): 4.0}
    assert run() == run() and late_readings(spark, sink).count() == 1


def test_dedupe_does_not_depend_on_files(spark):
    rng = random.Random(5)
    rows = [("ab"[i % 2], f"2024-01-{1 + i % 9:02d} {i % 5:02d}:00:00", rng.randrange(100), float(i)) for i in range(400)]
    want = {}
    for s, t, r, v in rows:
        want[s, t] = min(want.get((s, t), (r, v)), (r, v))
    schema = _readings(spark, []).schema
    for seed, max_files in ((1, 1), (2, 3), (3, None)):
        random.Random(seed).shuffle(rows)
        src, sink = shared_path(spark, "t-any"), shared_path(spark, "t-any-out")
        for part, again in ((rows[:150], False), (rows[150:], True)):  # the second call restarts from the checkpoint
            for lo in range(0, len(part), 60):
                _append(spark, src, part[lo:lo + 60])
            out = stream_dedupe(spark, src, schema, sink, order=("reading_id", "load"), max_files=max_files)
        assert {(r.series_id, str(r.ts)): (r.reading_id, r.load) for r in out.collect()} == want
    # state that is gone does not change the result
    sink = shared_path(spark, "t-short-out")
    out = stream_dedupe(spark, src, schema, sink, order=("reading_id", "load"), retention="1 second", max_files=1)
    assert {(r.series_id, str(r.ts)): (r.reading_id, r.load) for r in out.collect()} == want


def test_empty_stream(spark):
    raw = B.demand_raw(spark, SF).limit(0)
    src = shared_path(spark, "t-empty")
    raw.write.parquet(src)
    assert stream_hourly_rollup(spark, src, raw.schema, shared_path(spark, "t-empty-out")).count() == 0


def _table(spark, rows, path):
    df = spark.createDataFrame(rows, "series_id string, ts string, v double").withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    df.withColumn("day", F.to_date("ts")).write.partitionBy("day").parquet(path)
    return df


def test_replace_range_is_per_series_and_empties_days(spark):
    hours = [f"2024-01-0{d} {h:02d}:00:00" for d in (1, 2, 3) for h in range(24)]
    path = shared_path(spark, "t-replace")
    _table(spark, [(s, t, 1.0) for s in "ab" for t in hours], path)
    batch = spark.createDataFrame([("a", t, 2.0) for t in hours if "-02 " not in t], "series_id string, ts string, v double")
    batch = batch.withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    report = replace_range(spark, path, batch).first()
    assert (report.inserted, report.deleted) == (48, 72)
    got = {(r.series_id, r.v): r.n for r in current_table(spark, path).groupBy("series_id", "v").agg(F.count("*").alias("n")).collect()}
    assert got == {("a", 2.0): 48, ("b", 1.0): 72}
    only = shared_path(spark, "t-replace-one")
    _table(spark, [("a", t, 1.0) for t in hours], only)
    report = replace_range(spark, only, batch).first()
    assert (report.inserted, report.deleted) == (48, 72) and current_table(spark, only).count() == 48
    assert tuple(replace_range(spark, only, batch.limit(0)).first()) == (0, 0)


def test_replace_stream_does_not_depend_on_batches(spark):
    hours = [f"2024-01-0{d} {h:02d}:00:00" for d in (1, 2, 3, 4) for h in range(24)]
    rows = []
    for order in ((0, 1, 2, 3), (3, 0, 2, 1)):
        path, src = shared_path(spark, "t-upsert"), shared_path(spark, "t-upsert-src")
        df = _table(spark, [(s, t, 1.0) for s in "ab" for t in hours], path)
        for d in order:
            df.where((F.dayofmonth("ts") == d + 1) & (F.col("series_id") == "a")).withColumn("v", F.lit(2.0)).coalesce(1).write.mode("append").parquet(src)
        out = stream_replace_range(spark, src, df.schema, path, max_files=1)
        rows.append(sorted(tuple(r) for r in out.select("series_id", "ts", "v").collect()))
    assert rows[0] == rows[1] and len(rows[0]) == 192 and sum(v == 2.0 for _, _, v in rows[0]) == 96
