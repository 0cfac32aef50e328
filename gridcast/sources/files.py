"""File sources and sinks.

Readers are declarative Spark scans; the only driver-side reads are of
schema-sized things (the width of CSV headers, a version listing). Landing writers
build feed files in the reference's formats from the test tables so the
readers have real inputs; every file set is written in parallel, one
file per day / year, never funnelled through one task.
"""

from __future__ import annotations

import re
import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridcast.functions.calendar import dst_flags_day25
from gridcast.functions.numeric import nan_to_null
from gridcast.session import materialize

# Input formats.
DEMAND_TS_FORMAT = "dd/MM/yyyy HH:mm"
DATE_FORMATS = ["dd/MM/yyyy", "dd-MM-yyyy", "dd/MM/yyyy HH:mm:ss", "dd-MM-yyyy HH:mm:ss"]
DEMAND_ACTUAL = "Actual Total Load (MW)"
DEMAND_FORECAST = "Day-ahead Total Load Forecast (MW)"
WEATHER_COLUMNS = {
    "temperature_2m (°C)": "temperature",
    "relative_humidity_2m (%)": "relative_humidity",
    "rain (mm)": "rain",
    "snow_depth (m)": "snow_depth",
    "snowfall (cm)": "snowfall",
}
WEATHER_ARRAYS = ["temperature_2m", "relative_humidity_2m", "rain", "snowfall", "snow_depth"]


# --------------------------------------------------------------------------
# parsing helpers
# --------------------------------------------------------------------------
def parse_interval_timestamp(col) -> "F.Column":
    """'dd/MM/yyyy HH:mm - dd/MM/yyyy HH:mm (TZ)' -> start as timestamp_ntz (A3)."""
    c = F.col(col) if isinstance(col, str) else col
    start = F.split_part(c, F.lit(" - "), F.lit(1))
    start = F.regexp_replace(start, r" \([A-Z]+\)$", "")
    return F.try_to_timestamp(start, F.lit(DEMAND_TS_FORMAT)).cast("timestamp_ntz")


def parse_multi_format_date(col) -> "F.Column":
    """First of four day-first formats that parses; NULL when none does (A4)."""
    c = F.col(col) if isinstance(col, str) else col
    return F.coalesce(*[F.try_to_timestamp(c, F.lit(f)) for f in DATE_FORMATS]).cast("timestamp_ntz")


def normalize_utc(col) -> "F.Column":
    """Offset-aware text -> the UTC instant as wall-clock timestamp_ntz; NULL when it does not parse (A5)."""
    c = F.col(col) if isinstance(col, str) else col
    return F.try_to_timestamp(c).cast("timestamp_ntz")   # session time zone is UTC


def normalize_wallclock(col) -> "F.Column":
    """Offset-aware text -> its local wall clock, offset dropped; NULL when it does not parse."""
    c = F.col(col) if isinstance(col, str) else col
    local = F.regexp_replace(c, r"(Z|[+-]\d{2}:?\d{2})$", "")
    return local.try_cast("timestamp_ntz")


# --------------------------------------------------------------------------
# readers (A1, A2, A7, A8)
# --------------------------------------------------------------------------
def _scan_by_header(spark: SparkSession, path: str, is_header, needed) -> DataFrame:
    """Rows of CSV files as two arrays, `names` (the header's) and `cells`, each file read by its own header line.

    A file's header is its line that `is_header` accepts, wherever it stands. Headers form a table of a row per
    file that is joined to the lines, so any number of layouts is parsed in one pass over them. A file without a
    header is read by the set's only layout if there is just one. Raises where a file set has no header, a header
    lacks a needed column, a file has different headers, or a file without one could be read by several.
    """
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"))
    heads = materialize(lines.where(is_header(F.col("value"))).groupBy("file").agg(
        F.min("value").alias("head"), F.max("value").alias("other")), "csv-headers")
    width = F.max(F.regexp_count("head", F.lit(","))) + 1  # at least as many as there are columns
    seen = heads.agg(width.alias("width"), F.min("head").alias("one"), (F.min("head") == F.max("head")).alias("alike"),
                     F.min(F.when(F.col("head") != F.col("other"), F.col("file"))).alias("mixed")).first()
    if seen["width"] is None:
        raise ValueError(f"{path}: no header lines")
    if seen["mixed"] is not None:
        raise ValueError(f"{seen['mixed']}: different header lines")
    schema = ", ".join(f"c{i} string" for i in range(seen["width"]))

    def cells(text):
        return F.transform(F.array(F.from_csv(text, schema)), lambda r: F.array(*[r[f"c{i}"] for i in range(seen["width"])]))[0]

    layouts = heads.select("file", "head", cells(F.col("head")).alias("names"))
    lacks = F.filter(F.array(*[F.when(~F.coalesce(ok, F.lit(False)), F.lit(what)) for what, ok in needed(F.col("names"))]), lambda c: c.isNotNull())
    bad = layouts.select("file", lacks.alias("lacks")).where(F.size("lacks") > 0).orderBy("file").limit(1).collect()
    if bad:
        raise ValueError(f"{bad[0]['file']}: header without {bad[0]['lacks']}")
    rows = lines.join(layouts, "file", "left")
    if seen["alike"]:
        only = F.lit(seen["one"])
        rows = rows.select("value", F.coalesce("head", only).alias("head"), F.coalesce("names", cells(only)).alias("names"))
    else:
        lost = F.raise_error(F.concat(F.col("file"), F.lit(": no header line, and several layouts")))
        rows = rows.select("value", F.when(F.col("head").isNull() & (F.trim("value") != ""), lost.cast("string")).otherwise(F.col("head")).alias("head"), "names")
    return rows.where(F.col("value") != F.col("head")).select("names", cells(F.col("value")).alias("cells"))


def _cell(name) -> Column:
    """The cell under a column name (text or expression) in rows of `_scan_by_header`."""
    place = F.array_position("names", F.lit(name) if isinstance(name, str) else name)
    return F.when(place > 0, F.get("cells", place.cast("int") - 1))


def _number(col) -> "F.Column":
    """Text -> double; NULL for bad text and for NaN (NULL is the only missing marker)."""
    return nan_to_null(col.try_cast("double"))


def scan_demand_csv(spark: SparkSession, path: str) -> DataFrame:
    """Demand CSV: the timestamp column is the first whose name has MTU or Time (A1).

    Each file is read by its own header; cells that do not parse are NULL.
    """
    def time_name(names):
        return F.get(F.filter(names, lambda c: c.contains("MTU") | c.contains("Time")), F.lit(0))

    def needed(names):
        return [("MTU", time_name(names).isNotNull()), *[(c, F.array_contains(names, c)) for c in (DEMAND_ACTUAL, DEMAND_FORECAST)]]

    rows = _scan_by_header(spark, path, lambda v: v.contains(DEMAND_ACTUAL), needed)
    return rows.select(parse_interval_timestamp(_cell(time_name(F.col("names")))).alias("ts"),
                       _number(_cell(DEMAND_ACTUAL)).alias("actual_load"), _number(_cell(DEMAND_FORECAST)).alias("forecast_load"))


def scan_weather_csv(spark: SparkSession, path: str) -> DataFrame:
    """Weather CSV with metadata lines of any number before the header (A2).

    Each file is read by its own header, so column orders may differ; data
    rows are the lines whose time parses, cells that do not parse are NULL.
    """
    rows = _scan_by_header(spark, path, lambda v: v.startswith("time,") | v.contains(",time,") | v.endswith(",time"),
                           lambda names: [(c, F.array_contains(names, c)) for c in ("time", *WEATHER_COLUMNS)])
    t = F.try_to_timestamp(_cell("time"))
    out = rows.where(t.isNotNull()).select(
        t.cast("timestamp_ntz").alias("ts"), *[_number(_cell(src)).alias(dst) for src, dst in WEATHER_COLUMNS.items()])
    return out.select("*", *dst_flags_day25("ts"))


def flatten_holiday_json(spark: SparkSession, path: str) -> DataFrame:
    """Holiday payload files (JSON arrays) -> typed holiday rows."""
    from gridcast.operators.calendar_ops import flatten_holidays
    schema = "date string, localName string, global boolean, types array<string>, counties array<string>"
    return flatten_holidays(spark.read.schema(schema).option("multiLine", True).json(path)).drop("ordinal")


def flatten_weather_arrays(spark: SparkSession, path: str) -> DataFrame:
    """Array payload -> hourly rows, left-inclusive time range, null rows dropped."""
    arrays = ", ".join(f"{a} array<double>" for a in WEATHER_ARRAYS)
    schema = f"hourly struct<time_start long, time_end long, interval long, {arrays}>"
    p = spark.read.schema(schema).option("multiLine", True).json(path)
    hr = F.col("hourly")
    times = F.sequence(hr["time_start"], hr["time_end"] - hr["interval"], hr["interval"])
    z = F.arrays_zip(times.alias("t"), *[hr[a].alias(a) for a in WEATHER_ARRAYS])
    rows = p.select(F.inline(z))
    out = rows.select(F.timestamp_seconds("t").cast("timestamp_ntz").alias("ts"), *WEATHER_ARRAYS)
    return out.na.drop("any").select("*", *dst_flags_day25("ts"))


# --------------------------------------------------------------------------
# sinks (A9, A10, A11, A17-A19)
# --------------------------------------------------------------------------
def append_table(df: DataFrame, path: str, partition_by=None, fmt: str = "parquet") -> None:
    """Append rows to a table directory."""
    w = df.write.mode("append").format(fmt)
    if partition_by:
        w = w.partitionBy(partition_by)
    w.save(path)


def _versions(spark: SparkSession, path: str) -> list[int]:
    """Complete versions of a replaced table."""
    base = f"{path.rstrip('/')}/_versions"
    return [v for v in list_versions(spark, base) if _exists(spark, f"{base}/v={v}/_SUCCESS")]


def _day_dirs(spark: SparkSession, path: str, day_col: str) -> dict[str, str]:
    """Folder of each day (as text in folder names): by the newest complete version, or as they lie in a plain table."""
    done = _versions(spark, path)
    if done:
        return {r["day"]: r["dir"] for r in spark.read.parquet(f"{path.rstrip('/')}/_versions/v={done[-1]}").collect()}
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    names = [st.getPath().getName() for st in p.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(p)]
    return {n.partition("=")[2]: path.rstrip("/") for n in names if n.startswith(f"{day_col}=")}


def current_table(spark: SparkSession, path: str, day_col: str = "day") -> DataFrame:
    """A day-partitioned table as its newest complete version has it; a table that was never replaced, as it lies."""
    if not _versions(spark, path):
        return spark.read.parquet(path)
    by_dir: dict[str, list[str]] = {}
    for day, folder in _day_dirs(spark, path, day_col).items():
        by_dir.setdefault(folder, []).append(f"{folder}/{day_col}={day}")
    parts = [spark.read.option("basePath", folder).parquet(*days) for folder, days in sorted(by_dir.items())]
    if not parts:
        return spark.read.parquet(path).limit(0)
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def replace_range(spark: SparkSession, target_path: str, batch: DataFrame, key: str = "ts",
                  day_col: str = "day", by=("series_id",)) -> DataFrame:
    """Per group `by`, delete target rows with key in [min, max] of the batch, then add the batch (A10).

    The target is partitioned by day. Days that lose or gain rows are written
    anew beside the table, and one small version table then names the folder of
    every day: its completion switches all readers (`current_table`) at once,
    and a job that stops before leaves the table as it was. Replaced folders
    stay until `drop_replaced`. Returns one row (inserted, deleted); an empty
    batch gives (0, 0) and writes nothing.
    """
    by, path = [by] if isinstance(by, str) else list(by), target_path.rstrip("/")
    batch = batch.withColumn(day_col, F.to_date(key))
    whole = batch.agg(F.min(key).alias("lo"), F.max(key).alias("hi"), F.count(F.lit(1)).alias("n")).first()
    if whole["n"] == 0:
        return spark.createDataFrame([(0, 0)], "inserted long, deleted long")
    ranges = batch.groupBy(*by).agg(F.min(key).alias("_lo"), F.max(key).alias("_hi"))
    target, dirs = current_table(spark, path, day_col), _day_dirs(spark, path, day_col)
    near = target.where(F.col(day_col).between(F.to_date(F.lit(whole["lo"])), F.to_date(F.lit(whole["hi"]))) | F.col(day_col).isNull())
    ranged = near.join(ranges, by, "left")
    gone = F.coalesce(F.col(key).between(F.col("_lo"), F.col("_hi")), F.lit(False))
    old = ranged.groupBy(day_col).agg(F.count_if(gone).alias("gone"), F.count_if(~gone).alias("kept"))
    new = batch.groupBy(F.col(day_col).alias("_day")).agg(F.count(F.lit(1)).alias("new"))
    days = old.join(new, F.col(day_col).eqNullSafe(F.col("_day")), "full").select(
        F.coalesce(F.coalesce(day_col, "_day").cast("string"), F.lit("__HIVE_DEFAULT_PARTITION__")).alias("day"),
        *[F.coalesce(c, F.lit(0)).alias(c) for c in ("gone", "kept", "new")]).where("gone > 0 or new > 0").collect()  # a row per day
    touched = [r["day"] for r in days]
    folder = f"{path}/_data/{uuid.uuid4().hex[:12]}"
    rows = ranged.where(~gone & F.coalesce(F.col(day_col).cast("string"), F.lit("__HIVE_DEFAULT_PARTITION__")).isin(touched))
    rows.select(*target.columns).unionByName(batch.select(*target.columns)).write.partitionBy(day_col).parquet(folder)
    for r in days:
        dirs.pop(r["day"], None)
        if r["kept"] or r["new"]:
            dirs[r["day"]] = folder
    _switch(spark, path, dirs)
    return spark.createDataFrame([(int(whole["n"]), int(sum(r["gone"] for r in days)))], "inserted long, deleted long")


def _switch(spark: SparkSession, path: str, dirs: dict[str, str]) -> None:
    """Write the next version: complete with its _SUCCESS file; a version that another writer began raises."""
    done = _versions(spark, path)
    following = f"{path}/_versions/v={(done[-1] if done else 0) + 1}"
    if _exists(spark, following) and not _exists(spark, f"{following}/_SUCCESS"):
        _delete(spark, following)  # left by a writer that stopped
    spark.createDataFrame(sorted(dirs.items()), "day string, dir string").coalesce(1).write.mode("error").parquet(following)


def drop_replaced(spark: SparkSession, path: str, day_col: str = "day") -> int:
    """Delete folders and versions that the newest version does not name; the number of day folders deleted."""
    path, done = path.rstrip("/"), _versions(spark, path)
    if not done:
        return 0
    dirs, n = _day_dirs(spark, path, day_col), 0
    keep = {f"{d}/{day_col}={day}" for day, d in dirs.items()}
    fs_path = spark._jvm.org.apache.hadoop.fs.Path
    fs = fs_path(path).getFileSystem(spark._jsc.hadoopConfiguration())
    folders = [path] + ([f"{path}/_data/{st.getPath().getName()}" for st in fs.listStatus(fs_path(f"{path}/_data"))])
    for folder in folders:
        for st in fs.listStatus(fs_path(folder)):
            name = st.getPath().getName()
            if name.startswith(f"{day_col}=") and f"{folder}/{name}" not in keep:
                fs.delete(st.getPath(), True)
                n += 1
    for v in done[:-1]:
        _delete(spark, f"{path}/_versions/v={v}")
    return n


def _exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def _delete(spark: SparkSession, path: str) -> None:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def list_versions(spark: SparkSession, base: str) -> list[int]:
    """Version numbers of `base/v=<n>` directories, numerically (not text) ordered."""
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(base)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(p):
        return []
    out = []
    for st in fs.listStatus(p):
        m = re.fullmatch(r"v=(\d+)", st.getPath().getName())
        if m and st.isDirectory():
            out.append(int(m.group(1)))
    return sorted(out)


def write_versioned(spark: SparkSession, df: DataFrame, base: str, fmt: str = "csv") -> int:
    """Write df as the next version (max existing + 1, 1 if none)."""
    v = (max(list_versions(spark, base), default=0)) + 1
    w = df.write.mode("error").format(fmt)
    if fmt == "csv":
        w = w.option("header", True)
    w.save(f"{base.rstrip('/')}/v={v}")
    return v


def load_training_frame(spark: SparkSession, base: str, schema: str | None = None,
                        series: str = "series_id") -> DataFrame:
    """Newest version, timestamp parsed, time_idx 0..n-1 per series, season string."""
    from gridcast.operators.series import position_index
    v = max(list_versions(spark, base))
    r = spark.read.option("header", True)
    r = r.schema(schema) if schema else r.option("inferSchema", True)
    df = r.csv(f"{base.rstrip('/')}/v={v}")
    df = df.withColumn("timestamp", F.col("timestamp").cast("timestamp_ntz")).withColumn(
        "season", F.col("season").cast("string"))
    return position_index(df, series, "timestamp", pos="time_idx")


def write_results(df: DataFrame, path: str, fmt: str = "csv") -> None:
    """Result sinks: CSV with header (or parquet), written in parallel."""
    w = df.write.mode("overwrite").format(fmt)
    if fmt == "csv":
        w = w.option("header", True)
    w.save(path)


def feed_summary(df: DataFrame, ts: str, value: str, series: str = "series_id", calendar: DataFrame | None = None) -> DataFrame:
    """Rows, first / last timestamp, min / max value per series.

    With a calendar (one row per date), also the public and the national
    holidays of the years that a series covers.
    """
    out = df.groupBy(series).agg(F.count(F.lit(1)).alias("rows"), F.min(ts).alias("first_ts"),
                                 F.max(ts).alias("last_ts"), F.min(value).alias("min_value"),
                                 F.max(value).alias("max_value"))
    if calendar is None:
        return out
    per_year = calendar.groupBy(F.year("date").alias("_y")).agg(
        F.count_if("is_public_holiday").alias("_p"), F.count_if("is_national").alias("_n"))
    years = df.select(series, F.year(ts).alias("_y")).distinct().join(per_year, "_y", "left").groupBy(series).agg(
        F.coalesce(F.sum("_p"), F.lit(0)).cast("long").alias("public_holidays"),
        F.coalesce(F.sum("_n"), F.lit(0)).cast("long").alias("national_holidays"))
    return out.join(years, series)


# --------------------------------------------------------------------------
# landing writers: reference feed formats built from the test tables
# --------------------------------------------------------------------------
def quarter_hour(ts) -> "F.Column":
    t = F.col(ts) if isinstance(ts, str) else ts
    secs = F.unix_timestamp(t.cast("timestamp"))
    return F.timestamp_seconds(F.floor(secs / 900) * 900).cast("timestamp_ntz")


def land_demand_csv(readings: DataFrame, path: str, ts: str = "ts") -> None:
    """15-minute demand CSV with an MTU interval column (one file per day)."""
    q = readings.groupBy(quarter_hour(ts).alias("_q")).agg(F.avg("load").alias("a"), F.avg("forecast").alias("f"))
    end = (F.col("_q") + F.expr("INTERVAL 15 MINUTES"))
    mtu = F.concat(F.date_format("_q", DEMAND_TS_FORMAT), F.lit(" - "), F.date_format(end, DEMAND_TS_FORMAT),
                   F.lit(" (CET)"))
    out = q.select(F.to_date("_q").alias("day"), mtu.alias("MTU (CET/CEST)"),
                   F.col("a").alias(DEMAND_ACTUAL), F.col("f").alias(DEMAND_FORECAST), "_q")
    (out.repartition("day").sortWithinPartitions("_q").drop("_q").write.mode("overwrite")
     .option("header", True).partitionBy("day").csv(path))


def land_weather_csv(weather: DataFrame, path: str, ts: str = "ts") -> None:
    """Weather CSV files (one per day): two metadata lines, a blank line, header, rows."""
    names = list(WEATHER_COLUMNS)
    header = "time," + ",".join(names)
    vals = F.concat_ws(",", F.date_format(ts, "yyyy-MM-dd'T'HH:mm"),
                       *[F.col(WEATHER_COLUMNS[n]).cast("string") for n in names])
    data = weather.select(F.to_date(ts).alias("day"), F.lit(4).alias("_k"), F.col(ts).alias("_t"), vals.alias("value"))
    days = weather.select(F.to_date(ts).alias("day")).distinct()
    meta = days.select("day", F.inline(F.array(*[
        F.struct(F.lit(i).alias("_k"), F.lit(None).cast("timestamp_ntz").alias("_t"), F.lit(v).alias("value"))
        for i, v in enumerate(["latitude,longitude,elevation,utc_offset_seconds,timezone",
                               "52.52,13.41,38.0,0,GMT", "", header])])))
    lines = data.unionByName(meta)
    (lines.repartition("day").sortWithinPartitions("day", "_k", "_t").select("day", "value")
     .write.mode("overwrite").partitionBy("day").text(path))


def land_holiday_json(payload: DataFrame, path: str) -> None:
    """One JSON array file per year, entries in date order."""
    item = F.struct(F.date_format("date", "yyyy-MM-dd").alias("date"), F.lit("holiday").alias("localName"),
                    F.col("global").alias("global"), F.col("types").alias("types"),
                    F.col("counties").alias("counties"))
    per = payload.groupBy(F.year("date").alias("year")).agg(
        F.sort_array(F.collect_list(F.struct(F.col("date").alias("d"), item.alias("x")))).alias("_a"))
    (per.select("year", F.to_json(F.transform("_a", lambda s: s["x"])).alias("value"))
     .write.mode("overwrite").partitionBy("year").text(path))


def _hour_getter(field: str):
    return lambda i: F.element_at(F.col("_m"), i)[field]


def land_weather_json(weather: DataFrame, path: str, ts: str = "ts") -> None:
    """One array payload per day over its 24 hours; absent hours are null."""
    cols = {"temperature_2m": "temperature", "relative_humidity_2m": "relative_humidity", "rain": "rain",
            "snowfall": "snowfall", "snow_depth": "snow_depth"}
    per = weather.groupBy(F.to_date(ts).alias("day")).agg(F.map_from_entries(F.collect_list(F.struct(
        F.hour(ts), F.struct(*[F.col(v).alias(k) for k, v in cols.items()])))).alias("_m"))
    start = F.unix_timestamp(F.col("day").cast("timestamp"))
    hours = F.sequence(F.lit(0), F.lit(23))
    payload = F.struct(F.struct(
        start.alias("time_start"), (start + 86400).alias("time_end"), F.lit(3600).cast("long").alias("interval"),
        *[F.transform(hours, _hour_getter(k)).alias(k) for k in cols]).alias("hourly"))
    per.select("day", F.to_json(payload).alias("value")).write.mode("overwrite").partitionBy("day").text(path)
