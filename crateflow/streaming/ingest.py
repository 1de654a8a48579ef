"""Incremental forms of loading, over any streaming source."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def parquet_stream(spark: SparkSession, path: str, schema, files_per_trigger: int = 1) -> DataFrame:
    """New parquet files of a folder as a stream."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(path)


def first_wins(stream: DataFrame, key: list[str], event_time: str, lateness: str = "1 day") -> DataFrame:
    """One row per key within the lateness; state older than the watermark goes."""
    return stream.withWatermark(event_time, lateness).dropDuplicatesWithinWatermark(key)


def windowed_counts(stream: DataFrame, event_time: str, group: str, width: str, lateness: str) -> DataFrame:
    """(start, group, n) per time window; late rows within the watermark still count."""
    counted = stream.withWatermark(event_time, lateness).groupBy(F.window(event_time, width), group).agg(F.count("*").alias("n"))
    return counted.select(F.col("window.start").alias("start"), group, "n")


def latest_rows(spark: SparkSession, path: str, before: int | None = None, buckets: list[int] | None = None) -> DataFrame:
    """The rows that ``upsert_sink`` holds, as of before an epoch: each bucket's last version. Only the wanted buckets' files are read."""
    every = spark.read.parquet(path)
    if before is not None:
        every = every.where(F.col("v") < before)
    if buckets is not None:
        every = every.where(F.col("bucket").isin(buckets))
    last = every.groupBy("bucket").agg(F.max("v").alias("v")).collect()  # a row a bucket
    wanted = F.lit(False)
    for r in last:
        wanted = wanted | ((F.col("bucket") == r["bucket"]) & (F.col("v") == r["v"]))
    return every.where(wanted).drop("bucket", "v")


def upsert_sink(path: str, key: str, order: str, buckets: int = 64):
    """A foreachBatch function that keeps the latest row per key in a parquet folder, hashed into buckets by the key. A batch writes a version of
    the buckets that it touches and leaves the others; a batch that is retried writes the same version again. ``latest_rows`` reads the table."""

    def write(batch: DataFrame, epoch: int) -> None:
        spark = batch.sparkSession
        bucket = F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")
        rows = batch
        if epoch > 0:
            touched = [r[0] for r in batch.select(bucket).distinct().collect()]  # at most one a bucket
            rows = batch.unionByName(latest_rows(spark, path, epoch, touched), allowMissingColumns=True)
        latest = rows.groupBy(key).agg(F.max_by(F.struct(*rows.columns), order).alias("_r")).select("_r.*").withColumn("bucket", bucket)
        latest.write.mode("overwrite").partitionBy("bucket").parquet(f"{path}/v={epoch}")

    return write
