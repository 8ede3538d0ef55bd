"""Structured Streaming forms of the batch operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from ..operators.dedup import merge_latest


def arrivals(spark: SparkSession, path: str, schema: StructType, per_trigger: int = 1000) -> DataFrame:
    """Files of a folder as they arrive."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", per_trigger).parquet(path)


def with_event_time(df: DataFrame, column: str, delay: str) -> DataFrame:
    """Event time as a TIMESTAMP (files hold it without a zone) with a watermark."""
    return df.withColumn(column, F.col(column).cast("timestamp")).withWatermark(column, delay)


def daily_counts(events: DataFrame, time: str, keys: list[str], delay: str = "2 days", unique: str | None = None) -> DataFrame:
    """Counts by day and key; of rows with one id the first counts, while the watermark remembers it."""
    e = with_event_time(events, time, delay)
    if unique:
        e = e.dropDuplicatesWithinWatermark([unique])
    return e.groupBy(F.window(time, "1 day").alias("w"), *keys).agg(F.count("*").alias("n")).select(F.to_date("w.start").alias("day"), *keys, "n")


def sessions(events: DataFrame, time: str, key: str, gap: str = "30 minutes", delay: str = "1 day") -> DataFrame:
    """Sessions by key: a gap ends one."""
    e = with_event_time(events, time, delay)
    return e.groupBy(F.session_window(time, gap).alias("w"), key).agg(F.count("*").alias("n")).select(key, F.col("w.start").alias("start"), F.col("w.end").alias("end"), "n")


def upsert_latest(stream: DataFrame, target: str, keys: list[str], when: str, checkpoint: str) -> StreamingQuery:
    """Keep the latest row of each key in a table that each batch replaces: versions alternate, the pointer moves last."""

    def apply(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        pointer = f"{target}/current"
        try:
            at = spark.read.text(pointer).first()[0]
        except Exception as e:  # no table yet
            if "PATH_NOT_FOUND" not in str(e):
                raise
            at = None
        merged = batch if at is None else merge_latest(spark.read.parquet(at), batch, keys, when)
        if at is None:
            merged = merge_latest(batch.limit(0), batch, keys, when)
        new = f"{target}/v{number}"
        merged.write.mode("overwrite").parquet(new)
        spark.createDataFrame([(new,)], "value string").coalesce(1).write.mode("overwrite").text(pointer)

    return stream.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def run_to_files(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Process what there is and stop; rows are appended to Parquet files, each batch once."""
    return stream.writeStream.format("parquet").option("path", path).outputMode("append").option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
