"""Small frames for tests."""

from pyspark.sql import functions as F


def hourly(spark, values, start="2024-01-01 00:00:00", series="s", step_hours=1, name="x"):
    """A small hourly frame (series_id, ts, <name>) from a list of values."""
    rows = [(series, i, v) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, f"series_id string, i int, {name} double")
    return df.select("series_id", (F.lit(start).cast("timestamp_ntz") + F.make_interval(hours=F.col("i") * step_hours))
                     .alias("ts"), name)
