"""Streams: the ledger as it grows, re-uploads dropped within a watermark, windowed counts with late data."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.readers import LEDGER


def ledger_stream(spark: SparkSession, path: str, files: int = 100) -> DataFrame:
    """New ledger files, with an event time."""
    return spark.readStream.schema(LEDGER).option("maxFilesPerTrigger", files).json(path).withColumn("at", F.timestamp_seconds("ts"))


def first_uploads(stream: DataFrame, key: str, at: str, late: str = "7 days") -> DataFrame:
    """The first row of every key; state is dropped once the watermark has passed."""
    return stream.withWatermark(at, late).dropDuplicatesWithinWatermark([key])


def windowed(stream: DataFrame, at: str, by: list[str], size: str = "1 hour", late: str = "10 minutes") -> DataFrame:
    """Counts and sums a window; rows later than the watermark are left out."""
    g = stream.withWatermark(at, late).groupBy(F.window(at, size), *by)
    return g.agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 4).alias("total"))


def run_once(df: DataFrame, out: str, checkpoint: str, mode: str = "append") -> None:
    """Processes what is there and ends; a later run goes on from the checkpoint."""
    df.writeStream.outputMode(mode).format("parquet").option("path", out).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
