"""Key dedupe and duplicate probes.

Keep-first / keep-last are aggregations (min_by / max_by over an explicit
sequence column), not windows: they combine map-side, so a key holding a
huge share of the rows never lands whole in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridcast.functions.calendar import dst_summer_day25


def _keep(df: DataFrame, key, seq, last: bool) -> DataFrame:
    key = [key] if isinstance(key, str) else list(key)
    seq = [seq] if isinstance(seq, str) else list(seq)
    rest = [c for c in df.columns if c not in key]
    pick = F.max_by if last else F.min_by
    agg = df.groupBy(*key).agg(pick(F.struct(*rest), F.struct(*seq)).alias("_r"))
    return agg.select(*key, *[F.col("_r")[c].alias(c) for c in rest]).select(*df.columns)


def dedupe_keep_last(df: DataFrame, key, seq) -> DataFrame:
    """One row per key: the one with the highest sequence, a column or several."""
    return _keep(df, key, seq, last=True)


def dedupe_keep_first(df: DataFrame, key, seq) -> DataFrame:
    """One row per key: the one with the lowest sequence, a column or several."""
    return _keep(df, key, seq, last=False)


def duplicate_keys(df: DataFrame, key, limit: int | None = 5) -> DataFrame:
    """Keys occurring more than once with their counts, key order, top `limit`."""
    key = [key] if isinstance(key, str) else list(key)
    out = (df.groupBy(*key).agg(F.count(F.lit(1)).alias("count"))
           .where(F.col("count") > 1).orderBy(*key))
    return out.limit(limit) if limit else out


def duplicate_timestamps(df: DataFrame, series="series_id", ts: str = "ts") -> DataFrame:
    """Timestamp uniqueness per series: repeats beyond first and repeated keys (V6)."""
    series = [series] if isinstance(series, str) else list(series)
    per = df.groupBy(*series, ts).agg(F.count(F.lit(1)).alias("_c"))
    return per.groupBy(*series).agg(
        F.sum(F.col("_c") - 1).cast("long").alias("duplicate_rows"),
        F.count(F.when(F.col("_c") > 1, 1)).alias("repeated_timestamps"),
        F.count(F.lit(1)).alias("distinct_timestamps"),
    ).withColumn("passed", F.col("duplicate_rows") == 0)


def zero_unavailability(demand: DataFrame, ts: str = "ts", keys=("series_id",)) -> DataFrame:
    """Zero-filled unavailability rows for each demand timestamp."""
    s = dst_summer_day25(ts)
    return demand.select(*keys, ts,
                         F.lit(0.0).alias("planned_unavailability"),
                         F.lit(0.0).alias("actual_unavailability"),
                         F.lit(0.0).alias("total_unavailability"),
                         (~s).alias("daylight_savings_winter"), s.alias("daylight_savings_summer"))
