"""Frame validation.

Checks are one-pass aggregations stacked to long rows. Near-duplicate
detection never compares all pairs of a bucket: a pair can only reach
similarity >= t if *every* column's relative difference is at most
delta = m * (1 - t), so rows are blocked on a log-scale bin of the first
numeric column (bin width = -ln(1 - delta)) and only same-or-adjacent
bins are joined. The blocking is exact -- it can only drop pairs that
cannot pass -- and the equi-join lets AQE split a hot bucket.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from gridcast.functions.calendar import hour_floor
from gridcast.operators.series import join_stats
from gridcast.session import materialize

# Thresholds and expected ranges.
DUPLICATE_SIMILARITY_THRESHOLD = 0.999
EXPECTED_RANGES = {
    "target_demand": (30000, 90000),
    "temperature": (-20, 40),
    "humidity": (0, 100),
    "planned_unavailability": (0, 50000),
    "actual_unavailability": (0, 50000),
}
LEAKAGE_PAIRS = [
    ("demand_rolling_mean_30d", "target_demand"),
    ("demand_rolling_mean_7d", "target_demand"),
    ("temp_rolling_mean_30d", "temperature"),
]
TINY = 1e-10
NULL_BIN = -(2 ** 62)


def numeric_columns(df: DataFrame, exclude=()) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NumericType) and f.name not in exclude]


def row_similarity(a: str, b: str, cols) -> Column:
    """1 - mean relative difference; both-null skipped, one-null counts 1."""
    if not cols:
        return F.lit(0.0)
    total, count = F.lit(0.0), F.lit(0)
    for c in cols:
        x, y = F.col(f"{a}.{c}").cast("double"), F.col(f"{b}.{c}").cast("double")
        both = x.isNull() & y.isNull()
        one = x.isNull() | y.isNull()
        d = F.abs(x - y) / F.greatest(F.abs(x), F.abs(y), F.lit(TINY))
        diff = F.when(both, F.lit(None).cast("double")).when(one, F.lit(1.0)).otherwise(d)
        total = total + F.coalesce(diff, F.lit(0.0))
        count = count + F.when(diff.isNull(), 0).otherwise(1)
    return F.when(count == 0, F.lit(1.0)).otherwise(F.lit(1.0) - total / count)


def _bin(x: Column, width: float) -> Column:
    g = F.signum(x) * F.log(F.greatest(F.abs(x), F.lit(TINY)) / F.lit(TINY))
    return F.when(x.isNull(), F.lit(NULL_BIN)).otherwise(F.floor(g / F.lit(width))).cast("long")


def _sides(df: DataFrame, id_col: str, ts: str, cols, series, threshold: float, left: str, right: str):
    """Two aliased sides of the blocked self-join and its condition: same bucket, near bins, first id < second id.

    A pair reaches the threshold only if every column's relative difference is
    within a width, so rows meet in log-scale bins of the first column (the
    right side stands in three) and the second column's bins must be near too.
    A threshold so low that no single column bounds a pair raises.
    """
    delta = len(cols) * (1.0 - threshold)
    if not cols or delta >= 1.0:
        raise ValueError("threshold too low: no column bounds a pair, so rows cannot be blocked")
    width = -math.log(1.0 - delta)
    x = df.withColumn("_bucket", hour_floor(ts)).select(
        "*", *[_bin(F.col(c).cast("double"), width).alias(f"_bin{i}") for i, c in enumerate(cols[:2])])
    own = F.col("_bin0")
    near = F.when(own == NULL_BIN, F.array(own)).otherwise(F.array(own - 1, own, own + 1))
    one, other = x.alias(left), x.withColumn("_bin0", F.explode(near)).alias(right)
    cond = [F.col(f"a.{k}") == F.col(f"b.{k}") for k in [*series, "_bucket", "_bin0"]]
    if len(cols) > 1:
        p, q = F.col("a._bin1"), F.col("b._bin1")
        cond.append((p == NULL_BIN) | (q == NULL_BIN) | (F.abs(p - q) <= 1))
    return one, other, [*cond, F.col(f"a.{id_col}") < F.col(f"b.{id_col}")]


def near_duplicate_pairs(df: DataFrame, id_col: str, ts: str, cols=None, series=None,
                         threshold: float = DUPLICATE_SIMILARITY_THRESHOLD,
                         target: str | None = None) -> DataFrame:
    """Pairs (i < j) in the same floor-hour bucket with similarity >= threshold."""
    series = [series] if isinstance(series, str) else list(series or [])
    cols = list(cols) if cols is not None else numeric_columns(df, exclude=[id_col, ts])
    a, b, cond = _sides(df, id_col, ts, cols, series, threshold, "a", "b")
    out = a.join(b, cond).select(
        *[F.col(f"a.{s}").alias(s) for s in series],
        F.col(f"a.{id_col}").alias("index1"), F.col(f"b.{id_col}").alias("index2"),
        F.col(f"a.{ts}").alias("timestamp1"), F.col(f"b.{ts}").alias("timestamp2"),
        row_similarity("a", "b", cols).alias("similarity"),
        *([F.col(f"a.{target}").alias("demand1"), F.col(f"b.{target}").alias("demand2")] if target else []))
    return out.where(F.col("similarity") >= F.lit(threshold))


def near_duplicate_classes(df: DataFrame, id_col: str, ts: str, cols=None, series=None,
                           threshold: float = DUPLICATE_SIMILARITY_THRESHOLD) -> tuple[DataFrame, DataFrame]:
    """Near duplicates as classes of equal rows and links between classes (V1, J9); linear in repeated rows.

    Rows with equal columns in one (series, floor hour) form a class, named by
    its least id. Returns members (series, id, ts, class_id, class_rows) and
    links (series, class1 < class2, similarity) between classes; `expand_pairs`
    gives the pairs of rows behind them.
    """
    series = [series] if isinstance(series, str) else list(series or [])
    cols = list(cols) if cols is not None else numeric_columns(df, exclude=[id_col, ts])
    keys = [*series, "_bucket", *cols]
    x = df.select(*dict.fromkeys([*series, id_col, ts, *cols])).withColumn("_bucket", hour_floor(ts))
    groups = materialize(x.groupBy(*keys).agg(F.min(id_col).alias("class_id"), F.count(F.lit(1)).alias("class_rows"),
                                              F.min_by(ts, id_col).alias("_ts")), "near-classes")
    several = groups.where("class_rows > 1").select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], "class_id", "class_rows")
    same = [F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)]
    members = x.join(several, same, "left").select(
        *series, id_col, ts, F.coalesce("class_id", id_col).alias("class_id"), F.coalesce("class_rows", F.lit(1)).cast("long").alias("class_rows"))
    reps = groups.select(*series, F.col("class_id").alias("_rep"), F.col("_ts").alias(ts), *cols)
    links = near_duplicate_pairs(reps, "_rep", ts, cols, series, threshold).select(
        *series, F.col("index1").alias("class1"), F.col("index2").alias("class2"), "similarity")
    return members, links


def expand_pairs(members: DataFrame, links: DataFrame, id_col: str, series=None) -> DataFrame:
    """All pairs (index1 < index2) behind classes and links: quadratic in the size of classes, so for small sets."""
    series = [series] if isinstance(series, str) else list(series or [])
    one = members.select(*series, F.col("class_id").alias("_c1"), F.col(id_col).alias("_i"))
    two = members.select(*series, F.col("class_id").alias("_c2"), F.col(id_col).alias("_j"))
    within = one.join(two.withColumnRenamed("_c2", "_c1"), [*series, "_c1"]).where("_i < _j").select(
        *series, F.col("_i").alias("index1"), F.col("_j").alias("index2"), F.lit(1.0).alias("similarity"))
    across = links.join(one.withColumnRenamed("_c1", "class1"), [*series, "class1"]).join(
        two.withColumnRenamed("_c2", "class2"), [*series, "class2"])
    return within.unionByName(across.select(*series, F.least("_i", "_j").alias("index1"), F.greatest("_i", "_j").alias("index2"), "similarity"))


def near_duplicate_remove(df: DataFrame, id_col: str, ts: str, cols=None, series=None,
                          threshold: float = DUPLICATE_SIMILARITY_THRESHOLD) -> DataFrame:
    """Drop every row that is the second member of a pair (V2). An anti join: no pair is made."""
    series = [series] if isinstance(series, str) else list(series or [])
    cols = list(cols) if cols is not None else numeric_columns(df, exclude=[id_col, ts])
    b, a, cond = _sides(df, id_col, ts, cols, series, threshold, "b", "a")
    similar = row_similarity("a", "b", cols) >= F.lit(threshold)
    return b.join(a, [*cond, similar], "left_anti").select(*df.columns)


def check_missing(df: DataFrame, cols=None, series=None) -> DataFrame:
    """NULL count and % per column (V3); one aggregation, stacked."""
    series = [series] if isinstance(series, str) else list(series or [])
    cols = cols or [c for c in df.columns if c not in series]
    wide = df.groupBy(*series).agg(F.count(F.lit(1)).alias("_n"),
                                   *[F.sum(F.col(c).isNull().cast("long")).alias(f"_m{i}") for i, c in enumerate(cols)])
    cells = F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"_m{i}").alias("missing")) for i, c in enumerate(cols)])
    long = wide.select(*series, "_n", F.inline(cells))
    return long.select(*series, "column", "missing", (F.col("missing") / F.col("_n") * 100).alias("missing_pct"))


def check_continuity(df: DataFrame, series="series_id", ts: str = "ts") -> DataFrame:
    """Gaps: diff > 1 h and != 2 h (2 h counts as a DST transition) (V4)."""
    from gridcast.operators.series import time_gaps
    g = time_gaps(df, series, ts)
    return g.where((F.col("diff_seconds") > 3600) & (F.col("diff_seconds") != 7200)).select(
        *([series] if isinstance(series, str) else list(series)), "prev_ts", ts,
        (F.col("diff_seconds") / 3600.0).alias("gap_hours"))


def check_infinite(df: DataFrame, cols=None, series=None) -> DataFrame:
    """Count of +/-inf per numeric column (V5)."""
    series = [series] if isinstance(series, str) else list(series or [])
    cols = cols or numeric_columns(df, exclude=series)
    inf = float("inf")
    wide = df.groupBy(*series).agg(*[F.sum(F.abs(F.col(c).cast("double")).eqNullSafe(F.lit(inf)).cast("long"))
                                     .alias(f"_i{i}") for i, c in enumerate(cols)])
    cells = F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"_i{i}").alias("infinite")) for i, c in enumerate(cols)])
    return wide.select(*series, F.inline(cells))


def check_ranges(df: DataFrame, rules: dict | None = None, series=None) -> DataFrame:
    """Below / above counts and min / max per rule; absent columns skipped (V7)."""
    series = [series] if isinstance(series, str) else list(series or [])
    rules = {c: r for c, r in (rules or EXPECTED_RANGES).items() if c in df.columns}
    aggs = []
    for i, (c, (lo, hi)) in enumerate(rules.items()):
        x = F.col(c)
        aggs += [F.count(F.when(x < lo, 1)).alias(f"_b{i}"), F.count(F.when(x > hi, 1)).alias(f"_a{i}"),
                 F.min(x).cast("double").alias(f"_lo{i}"), F.max(x).cast("double").alias(f"_hi{i}")]
    wide = df.groupBy(*series).agg(*aggs)
    cells = F.array(*[F.struct(
        F.lit(c).alias("column"), F.lit(float(lo)).alias("min_allowed"), F.lit(float(hi)).alias("max_allowed"),
        F.col(f"_b{i}").alias("below"), F.col(f"_a{i}").alias("above"), F.col(f"_lo{i}").alias("min"),
        F.col(f"_hi{i}").alias("max")) for i, (c, (lo, hi)) in enumerate(rules.items())])
    long = wide.select(*series, F.inline(cells))
    return long.withColumn("passed", (F.col("below") == 0) & (F.col("above") == 0))


def check_leakage(df: DataFrame, pairs=None, series=None) -> DataFrame:
    """corr > 0.999 or > 50 % identical flags a lag column as leaking (V8)."""
    series = [series] if isinstance(series, str) else list(series or [])
    pairs = [(a, b) for a, b in (pairs or LEAKAGE_PAIRS) if a in df.columns and b in df.columns]
    if not pairs:
        return df.select(*series, F.lit(None).cast("string").alias("lag_col"),
                         F.lit(None).cast("string").alias("current_col"), F.lit(None).cast("double").alias("correlation"),
                         F.lit(None).cast("long").alias("identical"), F.lit(None).cast("long").alias("n"),
                         F.lit(None).cast("boolean").alias("suspicious")).where(F.lit(False))
    aggs = [F.count(F.lit(1)).alias("_n")]
    for i, (a, b) in enumerate(pairs):
        x, y = F.col(a).cast("double"), F.col(b).cast("double")
        aggs += [F.covar_pop(x, y).alias(f"_c{i}"), F.stddev_pop(x).alias(f"_sx{i}"), F.stddev_pop(y).alias(f"_sy{i}"),
                 F.count(F.when(x == y, 1)).alias(f"_e{i}")]
    wide = df.groupBy(*series).agg(*aggs)
    cells = F.array(*[F.struct(
        F.lit(a).alias("lag_col"), F.lit(b).alias("current_col"),
        F.try_divide(F.col(f"_c{i}"), F.when(F.col(f"_sx{i}") * F.col(f"_sy{i}") != 0,
                                             F.col(f"_sx{i}") * F.col(f"_sy{i}"))).alias("correlation"),
        F.col(f"_e{i}").alias("identical")) for i, (a, b) in enumerate(pairs)])
    long = wide.select(*series, "_n", F.inline(cells))
    susp = F.coalesce(F.col("correlation") > 0.999, F.lit(False)) | (F.col("identical") > F.col("_n") * 0.5)
    return long.select(*series, "lag_col", "current_col", "correlation", "identical",
                       F.col("_n").alias("n"), susp.alias("suspicious"))


def _spread_join(df: DataFrame, stats: DataFrame, series) -> DataFrame:
    """join_stats with the salts of a hot series taken from whole rows."""
    spread = "_spread"
    rows = df.withColumn(spread, F.xxhash64(*df.columns))
    return join_stats(rows, stats, series, spread).drop(spread)


def distribution(df: DataFrame, col: str, series, accuracy: int = 100_000, sigmas: float = 3.0) -> DataFrame:
    """Per group: n, mean, std, min, max, exact median, values beyond mean +/- sigmas * std.

    Two reads. The first aggregates and brackets the median by
    ``percentile_approx`` at ranks 0.5 -/+ 2/accuracy (rank error <= n/accuracy).
    The second counts rows below, at and above the bracket's ends and, strictly
    inside, per value: fewer than about 4n/accuracy rows, however many ties. A
    running sum over these counts finds the two middle order statistics, which
    are interpolated like ``percentile(x, 0.5)``; nothing ranks rows.
    """
    series = list(series)
    eps = 2.0 / accuracy
    x = df.select(*series, F.col(col).cast("double").alias("_y"), *[F.col(c).alias(f"_o{i}") for i, c in enumerate(df.columns) if c not in series])
    y = F.col("_y")
    st = x.groupBy(*series).agg(
        F.count(F.lit(1)).alias("n"), F.count("_y").alias("_m"), F.avg("_y").alias("mean"), F.stddev_samp("_y").alias("std"),
        F.min("_y").alias("min"), F.max("_y").alias("max"),
        F.percentile_approx("_y", [max(0.0, 0.5 - eps), min(1.0, 0.5 + eps)], accuracy).alias("_q"))
    st = materialize(st.select("*", F.col("_q")[0].alias("_lo"), F.col("_q")[1].alias("_hi")).drop("_q"), "distribution")
    j = _spread_join(x, st.select(*series, "mean", "std", "_lo", "_hi"), series)
    place = (F.when(y < F.col("_lo"), 0).when(y == F.col("_lo"), 1).when(y < F.col("_hi"), 2).when(y == F.col("_hi"), 3).otherwise(4))
    value = F.when(place.isin(1, 2, 3), y)
    beyond = F.abs(y - F.col("mean")) > sigmas * F.col("std")
    counts = j.where(y.isNotNull()).groupBy(*series, place.alias("_place"), value.alias("_value")).agg(
        F.count(F.lit(1)).alias("_k"), F.count_if(F.coalesce(beyond, F.lit(False))).alias("_out"))
    upto = F.sum("_k").over(Window.partitionBy(*series).orderBy("_place", "_value").rowsBetween(Window.unboundedPreceding, 0))
    steps = counts.select("*", upto.alias("_upto")).join(st.select(*series, "_m"), series)
    first, second = F.floor((F.col("_m") - 1) / 2), F.floor(F.col("_m") / 2)

    def holds(rank):
        return (F.col("_upto") > rank) & (F.col("_upto") - F.col("_k") <= rank)

    middle = steps.groupBy(*series).agg(
        F.sum("_out").alias("outliers"), F.max(F.when(holds(first), F.col("_value"))).alias("_a"),
        F.max(F.when(holds(second), F.col("_value"))).alias("_b"), F.max("_m").alias("_seen"))
    missed = F.col("_seen").isNotNull() & (F.col("_a").isNull() | F.col("_b").isNull())
    frac = (F.col("_m") - 1) / 2.0 - F.floor((F.col("_m") - 1) / 2.0)
    median = F.when(frac == 0, F.col("_a")).otherwise((F.lit(1.0) - frac) * F.col("_a") + frac * F.col("_b"))
    median = F.when(missed, F.raise_error(F.lit("the sketch's bracket misses the median"))).otherwise(median)
    return st.join(middle, series, "left").select(*series, "n", "mean", "std", "min", "max", median.cast("double").alias("median"),
                                                  F.coalesce("outliers", F.lit(0)).alias("outliers"))


def exact_median(df: DataFrame, col: str, series, accuracy: int = 100_000) -> DataFrame:
    """Exact median per group (see ``distribution``)."""
    return distribution(df, col, series, accuracy).select(*list(series), "median")


def check_target_distribution(df: DataFrame, target: str = "target_demand", series=None) -> DataFrame:
    """Mean, exact median, std, min, max and outliers beyond mean +/- 3 std (V9)."""
    series = [series] if isinstance(series, str) else list(series or [])
    whole = not series
    if whole:
        df, series = df.withColumn("_all", F.lit(1)), ["_all"]
    r = distribution(df, target, series).select(*series, "mean", "std", "min", "max", "n", "median", "outliers")
    if whole:
        r = r.drop("_all")
    return r.withColumn("outlier_pct", F.col("outliers") / F.col("n") * 100).withColumn(
        "passed", F.col("outliers") == 0)


def _one_pass_flags(df: DataFrame, target: str, series: str) -> DataFrame:
    """Per series, the checks that one aggregation decides: V3, V5, V7, V8 and the outlier flag of V9.

    A value lies beyond mean +/- 3 std exactly when the least or the greatest does.
    """
    def total(conditions):
        return sum((F.count_if(F.coalesce(c, F.lit(False))) for c in conditions), F.lit(0))

    inf = float("inf")
    rules = {c: r for c, r in EXPECTED_RANGES.items() if c in df.columns}
    pairs = [(a, b) for a, b in LEAKAGE_PAIRS if a in df.columns and b in df.columns]
    y = F.col(target)
    aggs = [total(F.col(c).isNull() for c in df.columns if c != series).alias("_missing"),
            total((F.col(c) < lo) | (F.col(c) > hi) for c, (lo, hi) in rules.items()).alias("_outside"),
            total(F.abs(F.col(c).cast("double")) == inf for c in numeric_columns(df, exclude=[series])).alias("_infinite"),
            F.avg(y).alias("_mean"), F.stddev_samp(y).alias("_std"), F.min(y).alias("_min"), F.max(y).alias("_max"),
            F.count(F.lit(1)).alias("_n")]
    for i, (a, b) in enumerate(pairs):
        x, z = F.col(a).cast("double"), F.col(b).cast("double")
        aggs += [F.covar_pop(x, z).alias(f"_c{i}"), (F.stddev_pop(x) * F.stddev_pop(z)).alias(f"_s{i}"),
                 F.count_if(x == z).alias(f"_e{i}")]
    leak = F.lit(False)
    for i in range(len(pairs)):
        leak = leak | F.coalesce(F.try_divide(f"_c{i}", f"_s{i}") > 0.999, F.lit(False)) | (F.col(f"_e{i}") > F.col("_n") * 0.5)
    return df.groupBy(series).agg(*aggs).select(
        series, (F.col("_missing") == 0).alias("missing_values"), (F.col("_outside") == 0).alias("data_ranges"),
        (F.col("_infinite") == 0).alias("infinite_values"), (~leak).alias("data_leakage"),
        F.coalesce((F.col("_min") >= F.col("_mean") - 3 * F.col("_std")) & (F.col("_max") <= F.col("_mean") + 3 * F.col("_std")),
                   F.lit(True)).alias("target_distribution"))


def validation_report(df: DataFrame, ts: str = "timestamp", target: str = "target_demand",
                      series: str = "series_id") -> DataFrame:
    """All checks on one frame -> (check, passed) rows per series.

    The frame is staged once; one aggregation decides five checks, continuity
    and repeated timestamps take one pass each.
    """
    from gridcast.operators.dedupe import duplicate_timestamps
    df = materialize(df, "validation-frame")
    gaps = check_continuity(df.select(series, ts), series, ts).groupBy(series).agg(F.lit(False).alias("temporal_continuity"))
    once = duplicate_timestamps(df, series, ts).select(series, F.col("passed").alias("duplicate_timestamps"))
    flags = _one_pass_flags(df, target, series).join(once, series).join(gaps, series, "left")
    checks = ["missing_values", "data_ranges", "temporal_continuity", "infinite_values", "duplicate_timestamps",
              "data_leakage", "target_distribution"]
    rows = F.array(*[F.struct(F.lit(i).alias("order"), F.lit(c).alias("check"), F.coalesce(c, F.lit(True)).alias("passed"))
                     for i, c in enumerate(checks)])
    return flags.select(series, F.inline(rows))


def sample_issues(gaps: DataFrame, dup_keys: DataFrame, pairs: DataFrame, series: str = "series_id",
                  ts: str = "ts") -> DataFrame:
    """First 5 gaps, first 5 repeated timestamps, top 10 near-duplicate pairs per series."""
    def first(df, issue, t, v, k, order):
        w = Window.partitionBy(series).orderBy(*order)
        return (df.withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= k)
                .select(series, F.lit(issue).alias("issue"), F.col(t).alias("ts"), F.col(v).cast("double").alias("value")))
    return (first(gaps, "gap", ts, "gap_hours", 5, [ts])
            .unionByName(first(dup_keys, "duplicate_timestamp", ts, "count", 5, [ts]))
            .unionByName(first(pairs, "near_duplicate", "timestamp1", "similarity", 10, ["index1", "index2"])))
