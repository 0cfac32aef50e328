"""Series primitives: positions, blocked windows, fills (golden fixtures + properties)."""

import math
import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from frames import hourly
from gridcast.operators import series as S


def _rows(df, *cols):
    return [tuple(r[c] for c in cols) for r in df.orderBy("series_id", "pos").collect()]


def test_position_is_permutation(spark):
    a = hourly(spark, [float(i) for i in range(100)], series="a")
    b = hourly(spark, [float(i) for i in range(37)], series="b", start="2024-03-01 05:00:00")
    p = S.position_index(a.unionByName(b), "series_id", "ts")
    got = {s: sorted(r.pos for r in p.where(F.col("series_id") == s).collect()) for s in ("a", "b")}
    assert got == {"a": list(range(100)), "b": list(range(37))}
    # order follows time
    assert [r.x for r in p.where("series_id = 'a'").orderBy("pos").collect()] == [float(i) for i in range(100)]


def test_block_form_equals_plain_window(spark):
    random.seed(7)
    vals = [random.gauss(50000, 5000) if i % 17 else None for i in range(400)]
    df = S.position_index(hourly(spark, vals), "series_id", "ts")
    small = S.lag_rows(df, "x", lags=(1, 24, 168), block_rows=170)
    w = Window.partitionBy("series_id").orderBy("pos")
    plain = df.select("*", *[F.lag("x", k).over(w).alias(f"x_lag_{k}") for k in (1, 24, 168)])
    cols = ["pos", "x_lag_1", "x_lag_24", "x_lag_168"]
    assert _rows(small, *cols) == _rows(plain, *cols)
    # rolling std in block form == single window
    blk = S.halo_blocks(df, "pos", before=167, block_rows=170)
    rs = S.core_only(S.rolling_std(blk, "x", 168, 24, "r"))
    ref = df.select("*", F.when(F.count("x").over(w.rowsBetween(-167, 0)) >= 24,
                                F.stddev_samp("x").over(w.rowsBetween(-167, 0))).alias("r"))
    a, b = _rows(rs, "pos", "r"), _rows(ref, "pos", "r")
    assert len(a) == len(b) == 400
    for (pa, ra), (pb, rb) in zip(a, b):
        assert pa == pb and ((ra is None and rb is None) or math.isclose(ra, rb, rel_tol=1e-12))


def test_ffill_bfill_null_inside_across_blocks(spark):
    vals = [None] + [float(i) for i in range(1, 30)] + [None, None, None] + [float(i) for i in range(33, 60)]
    df = S.position_index(hourly(spark, vals), "series_id", "ts")
    x = S.halo_blocks(df, "pos", 0, 0, block_rows=10)
    out = S.ffill_bfill(S.core_only(x), ["x"], "series_id", "pos")
    got = [r.x for r in out.orderBy("pos").collect()]
    assert got[0] == 1.0                      # head back-filled from first non-null
    assert got[30:33] == [29.0, 29.0, 29.0]   # forward filled across a block boundary (30 = block 3 start)
    assert got[33] == 33.0


def test_short_series_all_lags_empty(spark):
    df = S.position_index(hourly(spark, [float(i) for i in range(20)]), "series_id", "ts")
    out = S.lag_rows(df, "x", lags=(24,), fill="ffill_bfill")
    assert all(r.x_lag_24 is None for r in out.collect())
    rs = S.rolling_std_serve(df, "x")       # < 24 observations -> frame std / 1e4
    sd = df.agg(F.stddev_samp("x")).first()[0]
    assert all(math.isclose(r.rolling_std, sd / 1e4) for r in rs.collect())


def test_step_series_lags_and_reliability(spark):
    from gridcast.plans.train_features import train_features
    vals = [float(i) for i in range(200)]
    base = hourly(spark, vals, name="demand")
    df = base.select("series_id", F.col("ts").alias("timestamp"), "demand",
                     F.lit(10.0).alias("temperature_2m"), F.lit(0).alias("is_public_holiday"))
    tf = train_features(df, drop_incomplete=False, keep_pos=True, stage=False).orderBy("pos").collect()
    rel = [r.lag_reliability for r in tf]
    assert rel[0] == 0.0 and rel[23] == 0.0 and math.isclose(rel[24], 0.7) and math.isclose(rel[168], 1.0)
    mu, sd = sum(vals) / 200, (sum((v - 99.5) ** 2 for v in vals) / 199) ** 0.5
    z = [(v - mu) / sd for v in vals]
    assert math.isclose(tf[100].demand_lag_24h_norm, z[76], rel_tol=1e-9)
    assert math.isclose(tf[10].demand_lag_24h_norm, z[0], rel_tol=1e-9)     # back-filled head
    assert math.isclose(tf[190].demand_lag_168h_norm, z[22], rel_tol=1e-9)
    assert math.isclose(tf[100].demand_delta_24h, z[100] - z[76], rel_tol=1e-9)


def test_constant_series_guarded_division(spark):
    from gridcast.plans.train_features import train_features
    base = hourly(spark, [5.0] * 50, name="demand")
    df = base.select("series_id", F.col("ts").alias("timestamp"), "demand",
                     F.lit(3.0).alias("temperature_2m"), F.lit(0).alias("is_public_holiday"))
    rows = train_features(df, drop_incomplete=False, stage=False).collect()
    assert all(r.temp_severity is None and r.demand_lag_24h_norm is None for r in rows)
    # dropping incomplete rows removes them all (pandas: 0/0 -> NaN -> dropna)
    assert train_features(df, stage=False).count() == 0


def test_split_sizes_sum(spark):
    df = S.position_index(hourly(spark, [float(i) for i in range(97)]), "series_id", "ts")
    sp = {r.split: r["count"] for r in S.chronological_split(df).groupBy("split").count().collect()}
    assert sp == {"train": int(97 * 0.8), "val": int(97 * 0.9) - int(97 * 0.8), "test": 97 - int(97 * 0.9)}


def test_sequence_windows_count(spark):
    df = S.position_index(hourly(spark, [float(i) for i in range(100)]), "series_id", "ts")
    w = S.sequence_windows(df, "x", 10, 5, block_rows=16).orderBy("origin_pos").collect()
    assert len(w) == 100 - 10 - 5 + 1
    assert w[0].encoder == [float(i) for i in range(10)] and w[0].decoder == [10.0, 11.0, 12.0, 13.0, 14.0]
    assert w[-1].decoder[-1] == 99.0


def test_gap_series_continuity(spark):
    from gridcast.operators.validation import check_continuity
    ts = ["2024-01-01 00:00:00", "2024-01-01 01:00:00", "2024-01-01 03:00:00", "2024-01-01 06:00:00"]
    df = spark.createDataFrame([("s", t) for t in ts], "series_id string, t string").select(
        "series_id", F.col("t").cast("timestamp_ntz").alias("ts"))
    gaps = check_continuity(df).collect()
    assert len(gaps) == 1 and gaps[0].gap_hours == 3.0


def test_positioned_blocks_equals_two_step(spark):
    random.seed(5)
    rows = []
    for s, n in (("hot", 900), ("b", 130), ("c", 7)):
        t = 0
        for _ in range(n):
            t += random.choice([1, 1, 1, 2, 5, 30])
            rows.append((s, t, random.random()))
    df = spark.createDataFrame(rows, "series_id string, h int, x double").select(
        "series_id", (F.lit("2024-01-01").cast("timestamp_ntz") + F.make_interval(hours=F.col("h"))).alias("ts"), "x")
    for before, after, c in ((168, 0, 170), (24, 23, 50), (0, 0, 64)):
        a = S.halo_blocks(S.position_index(df, "series_id", "ts"), "pos", before, after, c)
        b = S.positioned_blocks(df, "series_id", "ts", "pos", before, after, c)
        key = lambda r: (r.series_id, r._blk, r.pos)
        ra = sorted((key(r), r._core, r.x) for r in a.collect())
        rb = sorted((key(r), r._core, r.x) for r in b.collect())
        assert ra == rb, (before, after, c)


def test_rolling_std_keeps_its_digits(spark):
    """Offsets of 1e9, a level shift inside a window, flat runs, nulls: as the two-pass formula to 1e-9."""
    rng = random.Random(2)
    vals = [1e9 + rng.gauss(0, 1000) for _ in range(300)] + [5.0 + rng.gauss(0, 1) for _ in range(300)] + [7.25] * 400
    vals += [None if i % 3 else 1e9 + i for i in range(200)] + [None] * 200
    df = S.position_index(hourly(spark, vals), "series_id", "ts")
    for block_rows in (200, 8192):
        blk = S.halo_blocks(df, "pos", before=167, block_rows=block_rows)
        got = {r.pos: r.r for r in S.core_only(S.rolling_std(blk, "x", 168, 24, "r")).collect()}
        assert sorted(got) == list(range(len(vals)))
        for p in range(len(vals)):
            w = [v for v in vals[max(0, p - 167):p + 1] if v is not None]
            if len(w) < 24:
                assert got[p] is None
            else:
                m = math.fsum(w) / len(w)
                want = math.sqrt(math.fsum((v - m) ** 2 for v in w) / (len(w) - 1))
                assert math.isclose(got[p], want, rel_tol=1e-9, abs_tol=1e-6 if want < 1 else 0), (p, got[p], want)
    assert got[990] == 0.0


def test_latest_n_ranks_one_day_only(spark):
    vals = [float(i) for i in range(6000)]
    df = hourly(spark, vals, series="a").unionByName(hourly(spark, vals[:30], series="b")).unionByName(
        hourly(spark, [1.0], series="b").withColumn("ts", F.lit(None).cast("timestamp_ntz")))
    for n in (1, 24, 25, 5000, 9999):
        got = S.latest_n_asof(df, None, n, ts="ts")
        by = {s: sorted(r.x for r in got.collect() if r.series_id == s) for s in "ab"}
        assert by == {"a": vals[-n:], "b": vals[:30][-n:]}
    assert S.latest_n_asof(df, "02/01/2024", 3, ts="ts").where("series_id = 'a'").agg(F.max("x")).first()[0] == 24.0
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "_day" in plan.split("Window", 1)[1]
