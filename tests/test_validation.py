"""Near-duplicate detection and checks."""

import random

from pyspark.sql import functions as F

from gridcast.operators import validation as V


def _frame(spark, rows):
    return spark.createDataFrame(rows, "rid long, t string, a double, b double").select(
        "rid", F.col("t").cast("timestamp_ntz").alias("ts"), "a", "b")


def test_similarity_threshold_and_null_rules(spark):
    t = "2024-01-01 00:10:00"
    rows = [
        (1, t, 1000.0, 1.0), (2, t, 1000.0, 1.0),           # identical -> 1.0
        (3, "2024-01-01 01:00:00", 1000.0, None), (4, "2024-01-01 01:30:00", 1000.0, None),  # both-null skipped
        (5, "2024-01-01 02:00:00", None, None), (6, "2024-01-01 02:10:00", None, None),      # nothing comparable
        (7, "2024-01-01 03:00:00", 1000.0, 5.0), (8, "2024-01-01 03:01:00", 1000.0, None),    # one null -> 1
        (9, "2024-01-01 04:00:00", 1000.0, 1.0), (10, "2024-01-01 04:00:00", 998.0, 1.0),     # 0.999
        (11, "2024-01-01 05:00:00", 1000.0, 1.0), (12, "2024-01-01 05:00:00", 997.8, 1.0),    # 0.9989
    ]
    p = V.near_duplicate_pairs(_frame(spark, rows), "rid", "ts", ["a", "b"])
    got = {(r.index1, r.index2): r.similarity for r in p.collect()}
    assert set(got) == {(1, 2), (3, 4), (5, 6), (9, 10)}
    assert got[(1, 2)] == 1.0 and got[(5, 6)] == 1.0


def test_blocking_is_exact_vs_brute_force(spark):
    random.seed(3)
    rows = []
    for i in range(600):          # one hot bucket holds a third of the rows
        t = "2024-01-01 00:30:00" if i < 200 else f"2024-01-01 {1 + i % 20:02d}:15:00"
        base = random.choice([100.0, 100.05, -3.0, 0.0, 1e-11, 2e-11, 5000.0])
        rows.append((i, t, base * (1 + random.choice([0, 0, 1e-4, 2e-3])), random.choice([1.0, 1.0005, None])))
    df = _frame(spark, rows)
    fast = {(r.index1, r.index2) for r in V.near_duplicate_pairs(df, "rid", "ts", ["a", "b"]).collect()}
    a, b = df.alias("a"), df.alias("b")
    brute = a.join(b, (F.date_trunc("hour", "a.ts") == F.date_trunc("hour", "b.ts")) & (F.col("a.rid") < F.col("b.rid")))
    brute = brute.select(F.col("a.rid").alias("i"), F.col("b.rid").alias("j"),
                         V.row_similarity("a", "b", ["a", "b"]).alias("s")).where("s >= 0.999")
    assert fast == {(r.i, r.j) for r in brute.collect()}
    assert len(fast) > 100


def test_remove_second_members(spark):
    rows = [(1, "2024-01-01 00:00:00", 1.0, 1.0), (2, "2024-01-01 00:20:00", 1.0, 1.0),
            (3, "2024-01-01 00:40:00", 1.0, 1.0), (4, "2024-01-01 00:50:00", 9.0, 1.0)]
    df = _frame(spark, rows)
    kept = V.near_duplicate_remove(df, "rid", "ts", ["a", "b"])
    assert sorted(r.rid for r in kept.collect()) == [1, 4]     # chain 1-2-3 keeps the first


def test_ranges_missing_infinite(spark):
    df = spark.createDataFrame([(1.0, 25000.0, None), (2.0, 95000.0, 50.0), (float("inf"), 50000.0, 20.0)],
                               "x double, target_demand double, temperature double")
    r = {x.column: x for x in V.check_ranges(df).collect()}
    assert set(r) == {"target_demand", "temperature"}
    assert (r["target_demand"].below, r["target_demand"].above, r["target_demand"].passed) == (1, 1, False)
    m = {x.column: x.missing for x in V.check_missing(df).collect()}
    assert m == {"x": 0, "target_demand": 0, "temperature": 1}
    inf = {x.column: x.infinite for x in V.check_infinite(df).collect()}
    assert inf["x"] == 1 and inf["target_demand"] == 0


def test_leakage_and_distribution(spark):
    df = spark.createDataFrame([(float(i), float(i), float(i % 7)) for i in range(50)],
                               "target_demand double, lagged double, other double")
    lk = V.check_leakage(df, [("lagged", "target_demand"), ("other", "target_demand"), ("absent", "x")]).collect()
    got = {r.lag_col: r.suspicious for r in lk}
    assert got == {"lagged": True, "other": False}
    d = V.check_target_distribution(df.withColumn("target_demand", F.when(F.col("lagged") == 0, 1e6)
                                                  .otherwise(F.col("target_demand")))).first()
    assert d.outliers == 1 and d.passed is False


def test_exact_median_matches_percentile(spark):
    random.seed(11)
    rows = [("a", float(random.randint(0, 50))) for _ in range(5001)]        # many ties, odd n
    rows += [("b", random.gauss(0, 1)) for _ in range(4000)]                   # distinct, even n
    rows += [("c", 7.0) for _ in range(300)] + [("d", 1.0), ("d", 2.0)]       # constant; two values
    df = spark.createDataFrame(rows, "s string, v double")
    got = {r.s: r.median for r in V.exact_median(df, "v", ["s"], accuracy=200).collect()}
    want = {r.s: r.m for r in df.groupBy("s").agg(F.median("v").alias("m")).collect()}
    assert set(got) == set(want)
    for k in want:
        assert abs(got[k] - want[k]) < 1e-12, (k, got[k], want[k])


def test_classes_stand_for_all_pairs(spark):
    random.seed(4)
    rows = [(i, f"2024-01-01 0{i % 3}:{i % 60:02d}:00", random.choice([100.0, 100.05, 100.4, None]), random.choice([1.0, 1.0005, None])) for i in range(150)]
    df = _frame(spark, rows)
    members, links = V.near_duplicate_classes(df, "rid", "ts", ["a", "b"])
    pairs = V.near_duplicate_pairs(df, "rid", "ts", ["a", "b"])
    want = sorted((r.index1, r.index2, round(r.similarity, 9)) for r in pairs.collect())
    got = sorted((r.index1, r.index2, round(r.similarity, 9)) for r in V.expand_pairs(members, links, "rid").collect())
    assert got == want and len(want) > 500
    assert members.count() == 150 and links.count() < 40


def test_classes_are_linear_in_equal_rows(spark):
    n = 100_000
    df = spark.range(n).select(F.col("id").alias("rid"), F.lit("2024-01-01 00:30:00").cast("timestamp_ntz").alias("ts"),
                               F.when(F.col("id") % 10 == 0, 100.05).otherwise(100.0).alias("a"), F.lit(1.0).alias("b"))
    members, links = V.near_duplicate_classes(df, "rid", "ts", ["a", "b"])
    assert [(r.class1, r.class2) for r in links.collect()] == [(0, 1)]
    assert {(r.class_id, r.class_rows): r.n for r in members.groupBy("class_id", "class_rows").agg(F.count("*").alias("n")).collect()} == {
        (0, n // 10): n // 10, (1, n - n // 10): n - n // 10}


def test_distribution_of_odd_groups(spark):
    nan_free = [("a", 1.0), ("a", None), ("b", None), ("c", 2.0), ("c", 4.0)] + [("d", float(i % 7)) for i in range(999)] + [("d", 1e6)]
    got = {r.s: r for r in V.distribution(spark.createDataFrame(nan_free, "s string, v double"), "v", ["s"], accuracy=50).collect()}
    assert (got["a"].median, got["b"].median, got["c"].median, got["d"].median) == (1.0, None, 3.0, 3.0)
    assert (got["b"].n, got["b"].outliers, got["d"].outliers) == (1, 0, 1)
