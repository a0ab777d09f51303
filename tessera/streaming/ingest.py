"""Streaming ingestion of append-only sample logs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery


def follow_log(spark: SparkSession, path: str, schema: T.StructType, key: str, time: str | None = None, delay: str = "1 day") -> DataFrame:
    """New rows of a growing folder of JSON lines; torn lines are left out.  With a time column, a
    key that repeats within the delay is left out too, and its state goes after that; without one
    nothing is remembered here, and `append_new` leaves repeats out."""
    bad = "_corrupt_line"
    rows = spark.readStream.schema(T.StructType([*schema.fields, T.StructField(bad, T.StringType())])).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", bad).json(path)
    rows = rows.where(F.col(bad).isNull()).drop(bad)
    return first_seen(rows, [F.col(key)], time, delay) if time else rows


def first_seen(stream: DataFrame, keys: list[Column], time: str, delay: str) -> DataFrame:
    """Rows whose keys were not seen within the delay: a gate's duplicates on a stream.  Keys are
    kept as digests and forgotten behind the watermark."""
    own = stream.withColumn("_seen", F.sha2(F.concat_ws("\u0001", *[F.coalesce(k.cast("string"), F.lit("\u0002")) for k in keys]), 256))
    return own.withWatermark(time, delay).dropDuplicatesWithinWatermark(["_seen"]).drop("_seen")


def append_new(stream: DataFrame, target: str, key: str, checkpoint: str) -> StreamingQuery:
    """Append each batch's rows whose key the target lacks, one a key; a repeated batch adds nothing.
    Of the target only the key column is read."""

    def write(batch: DataFrame, _: int) -> None:
        spark = batch.sparkSession
        try:
            known = spark.read.parquet(target).select(key)
        except Exception as e:  # no table yet
            if "PATH_NOT_FOUND" not in str(e):
                raise
            known = None
        fresh = batch.dropDuplicates([key])
        fresh = fresh if known is None else fresh.join(known, key, "left_anti")
        fresh.write.mode("append").parquet(target)

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
