"""Streaming counterparts of the polling feeds.

Sources are file streams over landed parquet. All state of a feed lies under
its sink (results, side tables, checkpoints), so calling it again with the same
sink goes on where it stopped: each micro-batch writes what it adds through
``foreachBatch``, keyed by its batch id, and a retried batch writes the same
again.

* Roll-up (R1): event time. Hours close when the watermark (latest reading
  minus ``lateness``) passes their end, and are then written once. Readings of
  closed hours go to a side table; hours still open at the end of a run come
  with ``flush``.
* Dedupe (R2): keyed state that lives for ``retention`` of delivery time. The
  result is the least row per key by ``order``, whatever the order of the files.
* Upsert (R3): ranges per series and day are replaced.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridcast.session import shared_path

#: Files in one micro-batch.
MAX_FILES = 8


def _run(frame: DataFrame, checkpoint: str, step, mode: str = "append") -> None:
    """Process all that is there now, a micro-batch at a time."""
    query = (frame.writeStream.foreachBatch(step).outputMode(mode).option("checkpointLocation", checkpoint)
             .trigger(availableNow=True).start())
    query.awaitTermination()
    if query.exception():
        raise RuntimeError(str(query.exception()))


def _stream(spark: SparkSession, path: str, schema, max_files: int | None) -> DataFrame:
    reader = spark.readStream.schema(schema)
    return (reader.option("maxFilesPerTrigger", max_files) if max_files else reader).parquet(path)


_PARTIAL = "series_id string, ts timestamp, last timestamp, total double, n long"
_CLOSED = "series_id string, ts timestamp_ntz, total double, n long"
_CLOCK = "latest timestamp, closed_before timestamp"


def stream_hourly_rollup(spark: SparkSession, src: str, schema, sink: str, value: str = "load", out: str = "actual_demand",
                         lateness: str = "10 days", max_files: int | None = MAX_FILES, flush: bool = True) -> DataFrame:
    """Hourly means per series over the readings of the stream, each hour written once when it closes.

    A first query reads the source once and writes sums per (series, hour) of
    each micro-batch, those of closed hours apart (`late_readings`); it closes
    hours by the latest reading of the micro-batches before. A second one adds
    the rest up in Spark's state store, in append mode under the same watermark.
    With ``flush`` the result also has the hours that are still open; they are
    not written and stay open for the next run. Readings without a time are left
    out.
    """
    spark.createDataFrame([], _PARTIAL).write.mode("overwrite").parquet(f"{sink}/partials/batch=-1/late=false")
    spark.createDataFrame([], _CLOSED).write.mode("overwrite").parquet(f"{sink}/closed/batch=-1")
    spark.createDataFrame([(None, None)], _CLOCK).write.mode("overwrite").parquet(f"{sink}/clock/batch=-1")
    time = F.col("ts").cast("timestamp")
    hour_end = F.col("ts") + F.expr("INTERVAL 1 HOUR")

    def gate(batch: DataFrame, epoch: int) -> None:
        before = spark.read.schema(_CLOCK).parquet(f"{sink}/clock/batch={epoch - 1}").first()
        sums = batch.where(F.col("ts").isNotNull()).groupBy("series_id", F.date_trunc("hour", time).alias("ts")).agg(
            F.max(time).alias("last"), F.sum(value).alias("total"), F.count(value).alias("n"))
        late = F.coalesce(hour_end <= F.lit(before["closed_before"]), F.lit(False))
        parts = f"{sink}/partials/batch={epoch}"
        sums.withColumn("late", late).write.mode("overwrite").partitionBy("late").parquet(parts)
        latest = F.greatest(F.max("last"), F.lit(before["latest"]))
        spark.read.schema(f"{_PARTIAL}, late boolean").parquet(parts).agg(latest.alias("latest")).select(
            "latest", (F.col("latest") - F.expr(f"INTERVAL {lateness}")).alias("closed_before")).write.mode("overwrite").parquet(
                f"{sink}/clock/batch={epoch}")

    def close(batch: DataFrame, epoch: int) -> None:
        batch.select("series_id", F.col("hour.start").cast("timestamp_ntz").alias("ts"), "total", "n").write.mode("overwrite").parquet(
            f"{sink}/closed/batch={epoch}")

    _run(_stream(spark, src, schema, max_files), f"{sink}/_checkpoints/gate", gate)
    on_time = _stream(spark, f"{sink}/partials/batch=*/late=false", _PARTIAL, None)
    hours = on_time.withWatermark("last", lateness).groupBy("series_id", F.window("last", "1 hour").alias("hour")).agg(
        F.sum("total").alias("total"), F.sum("n").alias("n"))
    _run(hours, f"{sink}/_checkpoints/close", close)
    rows = spark.read.schema(_CLOSED).parquet(f"{sink}/closed").select("series_id", "ts", "total", "n")
    if flush:
        clock = spark.read.schema(f"{_CLOCK}, batch long").parquet(f"{sink}/clock").agg(F.max("closed_before")).first()[0]
        parts = spark.read.schema(f"{_PARTIAL}, batch long, late boolean").parquet(f"{sink}/partials").where(~F.col("late"))
        if clock is not None:  # only around the border can an hour still be open
            parts = parts.where(hour_end >= F.lit(clock) - F.expr("INTERVAL 1 SECOND"))
        parts = parts.groupBy("series_id", F.col("ts").cast("timestamp_ntz").alias("ts")).agg(F.sum("total").alias("total"), F.sum("n").alias("n"))
        rows = rows.unionByName(parts.join(rows.select("series_id", "ts"), ["series_id", "ts"], "left_anti"))
    return rows.select("series_id", "ts", F.try_divide(F.col("total"), F.col("n")).alias(out))


def late_readings(spark: SparkSession, sink: str) -> DataFrame:
    """Side table of a roll-up: readings that came after their hour was closed, per micro-batch, series and hour."""
    rows = spark.read.schema(f"{_PARTIAL}, batch long, late boolean").parquet(f"{sink}/partials").where("late")
    return rows.select("batch", "series_id", F.col("ts").cast("timestamp_ntz").alias("ts"), "total", "n")


def stream_dedupe(spark: SparkSession, src: str, schema, sink: str, keys=("series_id", "ts"), order=("reading_id",),
                  retention: str = "10 days", max_files: int | None = MAX_FILES) -> DataFrame:
    """The least row by `order` of each key, whatever the order of the files (R2).

    Spark's state store holds each key's least row for ``retention`` of delivery
    time (when files were written, in which order they are also read, so that no
    row is too late). A micro-batch writes the keys that it touched; reading
    folds what was written, so a key that comes back after its state is gone
    still gets its least row.
    """
    keys = list(keys)
    rest = [f.name for f in schema.fields if f.name not in keys]

    def write(batch: DataFrame, epoch: int) -> None:
        batch.select(*keys, "least.*").write.mode("overwrite").parquet(f"{sink}/changes/batch={epoch}")

    spark.createDataFrame([], schema).write.mode("overwrite").parquet(f"{sink}/changes/batch=-1")
    least = F.min_by(F.struct(*rest), F.struct(*order)).alias("least")
    rows = _stream(spark, src, schema, max_files).select("*", F.col("_metadata.file_modification_time").alias("_delivered"))
    kept = rows.withWatermark("_delivered", retention).groupBy(F.window("_delivered", retention), *keys).agg(least)
    _run(kept, f"{sink}/_checkpoints/dedupe", write, "update")
    changes = spark.read.schema(schema).parquet(f"{sink}/changes")
    return changes.groupBy(*keys).agg(least).select(*keys, "least.*").select(*schema.names)


def stream_replace_range(spark: SparkSession, src: str, schema, target: str, prepare=None,
                         key: str = "ts", by=("series_id", "day"), max_files: int | None = MAX_FILES) -> DataFrame:
    """Each micro-batch replaces its key range per group in the target table.

    ``prepare`` maps a micro-batch to target rows (e.g. an hourly roll-up).
    Ranges are per series and day, so days in other micro-batches stay as they are.
    """
    from gridcast.sources.files import current_table, replace_range

    def upsert(batch: DataFrame, epoch: int) -> None:
        replace_range(batch.sparkSession, target, prepare(batch) if prepare else batch, key=key, by=by)

    _run(_stream(spark, src, schema, max_files), shared_path(spark, "ckpt-upsert"), upsert)
    return current_table(spark, target)
