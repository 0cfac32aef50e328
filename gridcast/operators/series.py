"""Ordered per-series operators (W1-W12) in a skew-proof shape.

A series can be arbitrarily long and one series can hold a third of all
rows, so nothing here windows over a whole series in one task:

* ``position_index`` numbers rows 0..n-1 per series from a small
  (series, day) count table plus a row_number inside each day.
* ``halo_blocks`` cuts each series into blocks of ``block_rows``
  positions and copies the last ``before`` (first ``after``) rows of a
  block into the next (previous) one, so lags and bounded rolling frames
  are exact inside ``Window.partitionBy(series, block)``.
* ``ffill_bfill`` fills inside each block, then carries the last non-null
  value across blocks through a small per-block table.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

DEFAULT_BLOCK_ROWS = 8192
BLK, CORE = "_blk", "_core"


def _cols(x) -> list[str]:
    if x is None:
        return []
    return [x] if isinstance(x, str) else list(x)


def position_index(df: DataFrame, series="series_id", order="ts", pos: str = "pos",
                   tiebreak=None, bucket: str = "day") -> DataFrame:
    """Dense position 0..n-1 per series in (order, tiebreak) order."""
    series, tiebreak = _cols(series), _cols(tiebreak)
    x = df.withColumn("_bkt", F.date_trunc(bucket, F.col(order)).cast("timestamp_ntz"))
    counts = x.groupBy(*series, "_bkt").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*series).orderBy("_bkt").rowsBetween(Window.unboundedPreceding, -1)
    offs = counts.select(*series, "_bkt", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    rn = F.row_number().over(Window.partitionBy(*series, "_bkt").orderBy(order, *tiebreak))
    x = x.withColumn("_rn", rn).join(offs, series + ["_bkt"])
    return x.withColumn(pos, (F.col("_off") + F.col("_rn") - 1).cast("long")).drop("_bkt", "_rn", "_off")


def halo_blocks(df: DataFrame, pos: str = "pos", before: int = 0, after: int = 0,
                block_rows: int = DEFAULT_BLOCK_ROWS) -> DataFrame:
    """Assign each row to its block, plus halo copies for its neighbours.

    Adds ``_blk`` (block id) and ``_core`` (true for the row's own block).
    Windows must partition by (series..., ``_blk``) and order by ``pos``;
    results are exact for core rows when lags <= before, leads <= after.
    """
    c = int(block_rows)
    if before > c or after > c:
        raise ValueError("halo larger than block")
    b = F.floor(F.col(pos) / F.lit(c)).cast("long")
    r = F.col(pos) - b * F.lit(c)
    empty = F.array().cast("array<bigint>")
    blocks = F.concat(
        F.when((r < F.lit(after)) & (b > 0), F.array(b - 1)).otherwise(empty) if after else empty,
        F.array(b),
        F.when(r >= F.lit(c - before), F.array(b + 1)).otherwise(empty) if before else empty,
    )
    return (df.withColumn("_b0", b).withColumn(BLK, F.explode(blocks))
            .withColumn(CORE, F.col(BLK) == F.col("_b0")).drop("_b0"))


def block_window(series="series_id", pos: str = "pos"):
    return Window.partitionBy(*_cols(series), BLK).orderBy(pos)


def core_only(df: DataFrame) -> DataFrame:
    """Drop halo copies, keeping ``_blk`` (the row's own block) for reuse."""
    return df.where(F.col(CORE)).drop(CORE)


def rolling_std(df: DataFrame, col: str, rows: int, min_periods: int, out: str, series="series_id", pos: str = "pos") -> DataFrame:
    """Adds the sample std over the last ``rows`` rows where they hold >= min_periods values, in O(1) per row.

    ``df`` is blocked with a halo of rows - 1 (dense positions). Positions are
    cut into chunks of ``rows``: the last ``rows`` rows are the end of the
    chunk before and the beginning of the own one, so running moments from both
    ends of each chunk, merged pairwise, give the deviation. Nothing is
    subtracted, so a large offset or a level shift costs no digits.
    """
    own = [*_cols(series), BLK, "_chunk"]
    x = df.withColumn("_chunk", F.floor(F.col(pos) / rows))
    running = (Window.unboundedPreceding, 0)

    def moments(w):
        return [F.count(col).over(w), F.avg(col).over(w), F.var_pop(col).over(w)]

    ends = moments(Window.partitionBy(*own).orderBy(F.desc(pos)).rowsBetween(*running))
    x = x.select("*", *[c.alias(f"_end{i}") for i, c in enumerate(ends)])
    starts = moments(Window.partitionBy(*own).orderBy(pos).rowsBetween(*running))
    x = x.select("*", *[c.alias(f"_start{i}") for i, c in enumerate(starts)])
    before = F.lag(F.struct("_end0", "_end1", "_end2"), rows - 1).over(block_window(series, pos))
    whole = F.pmod(F.col(pos), F.lit(rows)) == rows - 1  # the chunk is complete: nothing of the one before
    x = x.select("*", F.when(~whole, before).alias("_before"))
    n1, n2 = F.col("_start0"), F.coalesce("_before._end0", F.lit(0))
    apart = F.coalesce(F.col("_before._end1") - F.col("_start1"), F.lit(0.0))
    squares = (F.coalesce(n1 * F.col("_start2"), F.lit(0.0)) + F.coalesce(n2 * F.col("_before._end2"), F.lit(0.0))
               + F.coalesce(F.try_divide(apart * apart * n1 * n2, n1 + n2), F.lit(0.0)))
    std = F.when(n1 + n2 >= min_periods, F.sqrt(F.try_divide(squares, n1 + n2 - 1)))
    return x.select(*df.columns, std.alias(out))


def ffill_bfill(df: DataFrame, cols, series="series_id", pos: str = "pos",
                bfill: bool = True) -> DataFrame:
    """Forward fill, then back fill, per series, in ``pos`` order.

    ``df`` must carry ``_blk`` (from halo_blocks, halo rows removed).
    Inside a block a running ``last(ignorenulls)`` fills; a value missing
    at a block start comes from the last non-null of an earlier block
    (small per-block table, window over blocks); what is still missing is
    the head of the series and takes the series' first non-null value.
    """
    series, cols = _cols(series), _cols(cols)
    w = Window.partitionBy(*series, BLK).orderBy(pos).rowsBetween(Window.unboundedPreceding, 0)
    x = df.select("*", *[F.last(c, ignorenulls=True).over(w).alias(f"_ff_{c}") for c in cols])
    per_blk = x.groupBy(*series, BLK).agg(
        *[F.max(F.when(F.col(c).isNotNull(), F.struct(F.col(pos).alias("p"), F.col(c).alias("v"))))["v"]
          .alias(f"_last_{c}") for c in cols],
        *[F.min(F.when(F.col(c).isNotNull(), F.struct(F.col(pos).alias("p"), F.col(c).alias("v"))))
          .alias(f"_first_{c}") for c in cols])
    prev = Window.partitionBy(*series).orderBy(BLK).rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*series)
    carry = per_blk.select(
        *series, BLK,
        *[F.last(f"_last_{c}", ignorenulls=True).over(prev).alias(f"_carry_{c}") for c in cols],
        *[F.min(f"_first_{c}").over(whole)["v"].alias(f"_head_{c}") for c in cols])
    x = x.join(carry, series + [BLK], "left")
    filled = []
    for c in cols:
        parts = [F.col(f"_ff_{c}"), F.col(f"_carry_{c}")] + ([F.col(f"_head_{c}")] if bfill else [])
        filled.append(F.coalesce(*parts).alias(c))
    keep = [c for c in df.columns if c not in cols]
    return x.select(*keep, *filled).select(*df.columns)


#: Salts of a join to a table of one row per series.
SALTS = 32


def join_stats(df: DataFrame, stats: DataFrame, series="series_id", spread="pos") -> DataFrame:
    """Join a table of a row per series, a hot series being spread over SALTS keys by another column.

    AQE broadcasts the table when its runtime size allows.
    """
    series = _cols(series)
    salted = stats.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return df.withColumn("_salt", F.pmod(F.hash(spread), F.lit(SALTS))).join(salted, series + ["_salt"]).drop("_salt")


def series_stats(df: DataFrame, series="series_id", cols=("demand",)) -> DataFrame:
    """Frame-global mean, sample std and count per series.

    One aggregation; callers join it back (AQE broadcasts it when small).
    """
    aggs = [F.count(F.lit(1)).alias("n")]
    for c in cols:
        aggs += [F.avg(c).alias(f"{c}_mean"), F.stddev_samp(c).alias(f"{c}_std")]
    return df.groupBy(*_cols(series)).agg(*aggs)


def lag_rows(df: DataFrame, col: str, lags=(1, 7, 24, 168), series="series_id", pos: str = "pos",
             block_rows: int = DEFAULT_BLOCK_ROWS, fill: str | None = None,
             fill_value: Column | None = None) -> DataFrame:
    """Positional lags (W2); optional fill: 'ffill_bfill' (W3), 'value' (W4)."""
    series = _cols(series)
    w = block_window(series, pos)
    x = halo_blocks(df, pos, before=max(lags), block_rows=block_rows)
    names = [f"{col}_lag_{k}" for k in lags]
    x = core_only(x.select("*", *[F.lag(col, k).over(w).alias(n) for k, n in zip(lags, names)]))
    if fill == "ffill_bfill":
        x = ffill_bfill(x, names, series, pos)
    elif fill == "value":
        x = x.select(*[c for c in x.columns if c not in names],
                     *[F.coalesce(F.col(n), fill_value if fill_value is not None else F.col(col)).alias(n)
                       for n in names])
    return x.drop(BLK)


def chronological_split(df: DataFrame, series="series_id", pos: str = "pos",
                        train: float = 0.8, val: float = 0.1, n_col: str | None = None) -> DataFrame:
    """Label rows train/val/test by int(n*0.8), int(n*0.9) cut points."""
    series = _cols(series)
    x = df
    if n_col is None:
        counts = df.groupBy(*series).agg(F.count(F.lit(1)).alias("_n"))
        x = join_stats(df, counts, series, pos)
        n_col = "_n"
    n = F.col(n_col).cast("double")
    t_end = F.floor(n * F.lit(train))
    v_end = F.floor(n * F.lit(train + val))
    split = F.when(F.col(pos) < t_end, "train").when(F.col(pos) < v_end, "val").otherwise("test")
    out = x.withColumn("split", split)
    return out.drop("_n") if n_col == "_n" else out


def tail_slice(df: DataFrame, k: int, series="series_id", pos: str = "pos") -> DataFrame:
    """Last k positions of each series."""
    series = _cols(series)
    counts = df.groupBy(*series).agg(F.max(pos).alias("_last"))
    return join_stats(df, counts, series, pos).where(F.col(pos) > F.col("_last") - F.lit(k)).drop("_last")


def time_gaps(df: DataFrame, series="series_id", ts: str = "ts", block_rows: int = DEFAULT_BLOCK_ROWS) -> DataFrame:
    """Time difference to the previous row per series, in seconds.

    A lag inside blocks that hold the last row of the block before, so no
    single task sorts a whole series.
    """
    series = _cols(series)
    blk = positioned_blocks(df.select(*series, ts), series, ts, "_p", before=1, block_rows=block_rows)
    x = core_only(blk.select("*", F.lag(ts, 1).over(block_window(series, "_p")).alias("prev_ts")))
    return x.select(*series, "prev_ts", ts, F.expr(f"timestampdiff(SECOND, prev_ts, {ts})").alias("diff_seconds"))


def sequence_windows(df: DataFrame, value: str, encoder: int = 48, horizon: int = 24,
                     series="series_id", pos: str = "pos", ts: str = "ts",
                     block_rows: int = DEFAULT_BLOCK_ROWS) -> DataFrame:
    """Sliding encoder/decoder arrays, stride 1, full windows only.

    One row per decoder start s with encoder = values[s-E .. s-1] and
    decoder = values[s .. s+P-1]; n-E-P+1 rows on a series of n rows.
    """
    series = _cols(series)
    w = block_window(series, pos)
    x = halo_blocks(df.select(*series, pos, ts, value), pos, before=encoder, after=horizon - 1,
                    block_rows=block_rows)
    item = F.struct(F.col(value).alias("v"))
    enc = F.transform(F.collect_list(item).over(w.rowsBetween(-encoder, -1)), lambda s: s["v"])
    dec = F.transform(F.collect_list(item).over(w.rowsBetween(0, horizon - 1)), lambda s: s["v"])
    x = core_only(x.select(*series, pos, ts, BLK, CORE, enc.alias("encoder"), dec.alias("decoder")))
    x = x.where((F.size("encoder") == encoder) & (F.size("decoder") == horizon))
    return x.select(*series, F.col(pos).alias("origin_pos"), F.col(ts).alias("origin_ts"),
                    "encoder", "decoder")


def _with_stats(df: DataFrame, series, col: str, pos: str) -> DataFrame:
    st = df.groupBy(*_cols(series)).agg(F.avg(col).alias("_mu"), F.stddev_samp(col).alias("_sd"))
    return join_stats(df, st, series, pos)


def seasonal_delta(df: DataFrame, col: str, k: int = 24, series="series_id", pos: str = "pos",
                   out: str = "delta", block_rows: int = DEFAULT_BLOCK_ROWS) -> DataFrame:
    """x - x[k rows earlier], then ffill / bfill."""
    w = block_window(series, pos)
    x = core_only(halo_blocks(df, pos, before=k, block_rows=block_rows)
                  .select("*", (F.col(col) - F.lag(col, k).over(w)).alias(out)))
    return ffill_bfill(x, [out], series, pos).drop(BLK)


def rolling_std_train(df: DataFrame, col: str, series="series_id", pos: str = "pos",
                      rows: int = 168, min_periods: int = 24, out: str = "rolling_std",
                      block_rows: int = DEFAULT_BLOCK_ROWS) -> DataFrame:
    """Rolling sample std, ffill / bfill, divided by the frame std."""
    x = halo_blocks(_with_stats(df, series, col, pos), pos, before=rows - 1, block_rows=block_rows)
    x = core_only(rolling_std(x, col, rows, min_periods, out, series, pos))
    x = ffill_bfill(x, [out], series, pos)
    return x.withColumn(out, F.try_divide(F.col(out), F.col("_sd"))).drop(BLK, "_mu", "_sd")


def rolling_std_serve(df: DataFrame, col: str, series="series_id", pos: str = "pos",
                      rows: int = 168, min_periods: int = 24, scale: float = 10_000.0,
                      out: str = "rolling_std", block_rows: int = DEFAULT_BLOCK_ROWS) -> DataFrame:
    """Rolling sample std, missing -> frame std, divided by a scale."""
    x = halo_blocks(_with_stats(df, series, col, pos), pos, before=rows - 1, block_rows=block_rows)
    x = core_only(rolling_std(x, col, rows, min_periods, out, series, pos))
    return x.withColumn(out, F.coalesce(F.col(out), F.col("_sd")) / F.lit(scale)).drop(BLK, "_mu", "_sd")


def day_transition(df: DataFrame, ts: str = "ts", series="series_id", pos: str = "pos",
                   k: int = 24, out: str = "day_transition_type",
                   block_rows: int = DEFAULT_BLOCK_ROWS) -> DataFrame:
    """1 weekend->weekday, 2 weekday->weekend vs the weekday k rows earlier."""
    w = block_window(series, pos)
    d = F.weekday(ts)
    x = core_only(halo_blocks(df, pos, before=k, block_rows=block_rows)
                  .select("*", F.coalesce(F.lag(d, k).over(w), d).alias("_prev")))
    prev = F.col("_prev")
    return x.withColumn(out, F.when((prev >= 5) & (d < 5), 1.0).when((prev < 5) & (d >= 5), 2.0)
                        .otherwise(0.0)).drop("_prev", BLK)


def latest_n_asof(df: DataFrame, as_of: str | None, n: int = 1000, series="series_id", ts: str = "timestamp") -> DataFrame:
    """Latest n rows per series, with ts <= as_of if that is given.

    ``as_of`` is day-first text in one of four formats (A4); other text
    raises. Rows without a time are left out. Counts per (series, day) tell
    which days stand whole among the latest n; only the day that is cut is
    ranked, so no task sorts a series, whatever n.
    """
    series = _cols(series)
    df = df.where(F.col(ts).isNotNull())
    if as_of is not None:
        df = df.where(F.col(ts) <= F.lit(parse_as_of(as_of)).cast("timestamp_ntz"))
    x = df.withColumn("_day", F.to_date(ts))
    later = Window.partitionBy(*series).orderBy(F.desc("_day")).rowsBetween(Window.unboundedPreceding, -1)
    days = x.groupBy(*series, "_day").agg(F.count(F.lit(1)).alias("_n")).select(
        *series, "_day", "_n", (F.lit(n) - F.coalesce(F.sum("_n").over(later), F.lit(0))).alias("_room")).where("_room > 0")
    whole = x.join(days.where(F.col("_n") <= F.col("_room")).select(*series, "_day"), [*series, "_day"])
    cut = x.join(days.where(F.col("_n") > F.col("_room")).select(*series, "_day", "_room"), [*series, "_day"])
    ranked = cut.withColumn("_rk", F.row_number().over(Window.partitionBy(*series, "_day").orderBy(F.desc(ts)))).where("_rk <= _room")
    return whole.select(*df.columns).unionByName(ranked.select(*df.columns))


def parse_as_of(text: str) -> str:
    """A day-first date text as ISO text; ValueError when no format fits."""
    for f in ("%d/%m/%Y", "%d-%m-%Y", "%d/%m/%Y %H:%M:%S", "%d-%m-%Y %H:%M:%S"):
        try:
            return datetime.strptime(text, f).isoformat(sep=" ")
        except ValueError:
            pass
    raise ValueError(f"not a day-first date: {text!r}")


def positioned_blocks(df: DataFrame, series="series_id", order: str = "ts", pos: str = "pos",
                      before: int = 0, after: int = 0, block_rows: int = DEFAULT_BLOCK_ROWS,
                      tiebreak=None, bucket: str = "day", stats: DataFrame | None = None) -> DataFrame:
    """``halo_blocks(position_index(df))`` with a single full-row shuffle.

    A small (series, day) table gives each day its first position o_d and
    row count n_d; the day's rows are sent to every block their positions
    or halos touch, [floor((o_d - after) / C), floor((o_d + n_d - 1 + before) / C)],
    and positions are numbered inside the (series, block) partition by a
    row_number per day (same partitioning, no second shuffle). ``stats``, a
    table of a row per series, comes along in the day table.
    """
    series, tiebreak = _cols(series), _cols(tiebreak)
    c = int(block_rows)
    if before > c or after > c:
        raise ValueError("halo larger than block")
    x = df.withColumn("_bkt", F.date_trunc(bucket, F.col(order)).cast("timestamp_ntz"))
    counts = x.groupBy(*series, "_bkt").agg(F.count(F.lit(1)).alias("_n"))
    prev = Window.partitionBy(*series).orderBy("_bkt").rowsBetween(Window.unboundedPreceding, -1)
    days = counts.select(*series, "_bkt", "_n", F.coalesce(F.sum("_n").over(prev), F.lit(0)).alias("_off"))
    lo = F.floor(F.greatest(F.col("_off") - after, F.lit(0)) / c)
    hi = F.floor((F.col("_off") + F.col("_n") - 1 + before) / c)
    days = days.select(*series, "_bkt", "_off", F.sequence(lo, hi).cast("array<bigint>").alias("_blks"))
    if stats is not None:
        days = days.join(stats, series)
    x = x.join(days, series + ["_bkt"]).withColumn(BLK, F.explode("_blks")).drop("_blks")
    x = x.repartition(*[F.col(s) for s in series], F.col(BLK))
    rn = F.row_number().over(Window.partitionBy(*series, BLK, "_bkt").orderBy(order, *tiebreak))
    x = x.withColumn(pos, (F.col("_off") + rn - 1).cast("long"))
    return (x.withColumn(CORE, F.floor(F.col(pos) / c) == F.col(BLK)).drop("_bkt", "_off")
            .where(F.col(pos) >= F.col(BLK) * c - before)
            .where(F.col(pos) < (F.col(BLK) + 1) * c + after))
