"""Holiday calendar and DST frames."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridcast.functions.calendar import dst_flags_day25, dst_flags_month
from gridcast.operators.resample import date_spine

# The holiday rules used with the test data, per year
# (month, day, global, types, counties). New Year, Epiphany (three
# states), Labour Day, German Unity Day, Christmas Day, Boxing Day.
HOLIDAY_RULES = [
    (1, 1, True, ["Public"], None),
    (1, 6, False, ["Public"], ["DE-BW", "DE-BY", "DE-ST"]),
    (5, 1, True, ["Public"], None),
    (10, 3, True, ["Public"], None),
    (12, 25, True, ["Public"], None),
    (12, 26, True, ["Public"], None),
]


def _rules_array(year_col):
    items = []
    for i, (m, d, glob, types, counties) in enumerate(HOLIDAY_RULES):
        items.append(F.struct(
            F.make_date(year_col, F.lit(m), F.lit(d)).alias("date"),
            F.lit(glob).alias("global"),
            F.array(*[F.lit(t) for t in types]).alias("types") if types else
            F.lit(None).cast("array<string>").alias("types"),
            (F.array(*[F.lit(c) for c in counties]) if counties else
             F.lit(None).cast("array<string>")).alias("counties"),
            F.lit(i).alias("ordinal")))
    return F.array(*items)


def holiday_set_for(spark: SparkSession, df: DataFrame, ts: str) -> DataFrame:
    """Holiday payload rows (date, global, types, counties) for every year in df."""
    years = df.select(F.year(ts).alias("y")).distinct()
    return years.select(F.inline(_rules_array(F.col("y"))))


def flatten_holidays(payload: DataFrame) -> DataFrame:
    """Payload entries -> typed holiday rows; null lists act as empty (A7 core)."""
    types = F.coalesce(F.col("types"), F.array().cast("array<string>"))
    return payload.select(
        F.to_date("date").alias("date"),
        F.array_contains(types, "Public").alias("is_public_holiday"),
        F.coalesce(F.col("global"), F.lit(False)).alias("is_national"),
        F.try_element_at(types, F.lit(1)).alias("holiday_type"),
        F.coalesce(F.size("counties"), F.lit(0)).cast("int").alias("counties_affected"),
        *([F.col("ordinal")] if "ordinal" in payload.columns else [F.lit(0).alias("ordinal")]),
    ).where(F.col("date").isNotNull())


def holiday_calendar(spark: SparkSession, payload: DataFrame, years_from: DataFrame,
                     ts: str = "ts") -> DataFrame:
    """Every date of the covered years left-joined with holidays.

    Two entries on one date are pre-aggregated to one row per date (flags
    OR-ed, first type in payload order, most counties) so the calendar
    keeps the one-row-per-date key. The holiday side is bounded by the
    number of calendar days, so it is broadcast.
    """
    hol = flatten_holidays(payload).groupBy("date").agg(
        F.bool_or("is_public_holiday").alias("is_public_holiday"),
        F.bool_or("is_national").alias("is_national"),
        F.min_by("holiday_type", "ordinal").alias("holiday_type"),
        F.max("counties_affected").alias("counties_affected"))
    spine = date_spine(years_from, ts, "date")
    cal = spine.join(F.broadcast(hol), "date", "left")
    return cal.select(
        "date",
        F.coalesce("is_public_holiday", F.lit(False)).alias("is_public_holiday"),
        F.coalesce("is_national", F.lit(False)).alias("is_national"),
        F.coalesce("holiday_type", F.lit("")).alias("holiday_type"),
        F.coalesce("counties_affected", F.lit(0)).cast("int").alias("counties_affected"),
        *dst_flags_day25("date"))


def dst_frame_day25(df: DataFrame, ts: str) -> DataFrame:
    return df.select(ts, *dst_flags_day25(ts))


def dst_frame_month(df: DataFrame, ts: str) -> DataFrame:
    return df.select(ts, *dst_flags_month(ts, dtype="int"))


def missing_years(target: DataFrame, date_col: str, wanted_years) -> DataFrame:
    """Years in ``wanted_years`` not yet present in the target table."""
    spark = target.sparkSession
    want = spark.createDataFrame([(int(y),) for y in wanted_years], "year int")
    have = target.select(F.year(date_col).cast("int").alias("year")).distinct()
    return want.join(have, "year", "left_anti")
