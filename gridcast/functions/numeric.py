"""Numeric column helpers with pandas-compatible missing-value rules.

pandas and Spark disagree on nulls: `clip` keeps NaN while `greatest`
skips nulls, and a comparison with NaN is False in pandas but NULL in
Spark. These helpers pin the pandas behaviour down as Column expressions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def clip(x, lower=None, upper=None) -> Column:
    """pandas `clip`: bounds applied, null stays null."""
    x = _c(x)
    out = x
    if lower is not None and upper is not None:
        out = F.when(x < F.lit(lower), F.lit(lower)).when(x > F.lit(upper), F.lit(upper)).otherwise(x)
    elif lower is not None:
        out = F.when(x < F.lit(lower), F.lit(lower)).otherwise(x)
    elif upper is not None:
        out = F.when(x > F.lit(upper), F.lit(upper)).otherwise(x)
    return out.cast("double")


def flag(cond: Column, dtype: str = "int") -> Column:
    """Boolean condition to 0/1 where a NULL comparison counts as False."""
    return F.coalesce(cond, F.lit(False)).cast(dtype)


def nan_to_null(x) -> Column:
    """Keep NULL as the only missing marker (NaN > 5 is true in Spark)."""
    x = _c(x)
    return F.when(F.isnan(x), F.lit(None).cast("double")).otherwise(x)


def softplus(x) -> Column:
    """Numerically stable log(1 + e^x)."""
    x = _c(x)
    return F.greatest(x, F.lit(0.0)) + F.log1p(F.exp(-F.abs(x)))


def round_doubles(df: DataFrame, digits: int = 6, per_column: dict | None = None) -> DataFrame:
    """Round every floating column (and remove -0.0) for stable comparison."""
    per_column = per_column or {}
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (DoubleType, FloatType)):
            d = per_column.get(f.name, digits)
            cols.append((F.round(F.col(f.name), d) + F.lit(0.0)).alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)
