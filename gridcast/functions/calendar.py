"""Calendar column helpers: time parts, DST flags, seasons."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def weekday(ts) -> Column:
    """Monday = 0 ... Sunday = 6 (pandas `dayofweek`)."""
    return F.weekday(_c(ts))


def hour_floor(ts) -> Column:
    """Floor to the hour, staying in wall-clock `timestamp_ntz`."""
    return F.date_trunc("hour", _c(ts)).cast("timestamp_ntz")


def dst_summer_day25(ts) -> Column:
    """Summer time by the day-25 rule: Apr-Sep, or Mar >= 25, or Oct < 25."""
    m, d = F.month(_c(ts)), F.dayofmonth(_c(ts))
    return ((m > 3) & (m < 10)) | ((m == 3) & (d >= 25)) | ((m == 10) & (d < 25))


def dst_flags_day25(ts, winter="daylight_savings_winter", summer="daylight_savings_summer"):
    s = dst_summer_day25(ts)
    return [(~s).alias(winter), s.alias(summer)]


def dst_flags_month(ts, winter="daylight_savings_winter", summer="daylight_savings_summer",
                    dtype: str = "int"):
    """Month rule: winter = Nov..Mar, summer = Apr..Oct."""
    m = F.month(_c(ts))
    return [m.isin(11, 12, 1, 2, 3).cast(dtype).alias(winter),
            m.isin(4, 5, 6, 7, 8, 9, 10).cast(dtype).alias(summer)]


def season_train(month) -> Column:
    m = _c(month)
    return (F.when(m.isin(12, 1, 2), "winter").when(m.isin(3, 4, 5), "spring")
            .when(m.isin(6, 7, 8), "summer").when(m.isin(9, 10, 11), "autumn"))


def season_serve(month) -> Column:
    m = _c(month)
    return (F.when(m.isin(12, 1, 2), "Winter").when(m.isin(3, 4, 5), "Spring")
            .when(m.isin(6, 7, 8), "Summer").otherwise("Autumn"))
