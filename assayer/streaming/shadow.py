"""Windowed metrics of an event stream; the batch form is the reference for the stream."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from assayer.runtime import shared_dir

WINDOW = "1 hour"
LATE = "10 minutes"


def windowed(events: DataFrame, window: str = WINDOW) -> DataFrame:
    """Per window and type: events, sum and running peak of the value."""
    return (
        events.groupBy(F.window("ts", window).alias("w"), "event_type")
        .agg(F.count("*").alias("n"), F.round(F.sum("value"), 4).alias("total"), F.max("value").alias("peak"))
        .select(F.col("w.start").alias("start"), "event_type", "n", "total", "peak")
    )


def run_stream(spark: SparkSession, folder: str, name: str = "events", window: str = WINDOW, late: str = LATE, files: int = 1) -> DataFrame:
    """The files of a folder as a stream, to the end of what is there; the state is in the shared folder.

    Update mode: a micro-batch emits the windows it changed, the watermark drops windows that are ``late`` behind and rows that come later than that. Each batch
    is its own partition, written over when it is repeated, so readers never meet a half-written table; the last batch of a window holds.
    """
    schema = spark.read.parquet(f"{folder}/{name}.parquet").schema
    out = f"{shared_dir(spark)}/assayer-stream-{uuid.uuid4().hex}"
    source = spark.readStream.schema(schema).option("pathGlobFilter", f"{name}*.parquet").option("maxFilesPerTrigger", files).parquet(folder)
    local = schema["ts"].dataType.simpleString() == "timestamp_ntz"  # event time must be an instant
    found = windowed(source.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", late), window)

    def put(batch: DataFrame, n: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/table/batch={n}")

    spark.createDataFrame([], found.schema).write.parquet(f"{out}/table/batch=-1")
    found.writeStream.outputMode("update").option("checkpointLocation", f"{out}/state").trigger(availableNow=True).foreachBatch(put).start().awaitTermination()
    values = [c for c in found.columns if c not in ("start", "event_type")]
    done = latest_batch(spark.read.parquet(f"{out}/table"), ["start", "event_type"], values)
    return done.withColumn("start", F.col("start").cast("timestamp_ntz")) if local else done


def latest_batch(table: DataFrame, keys: list[str], values: list[str]) -> DataFrame:
    return table.groupBy(*keys).agg(F.max_by(F.struct(*values), "batch").alias("v")).select(*keys, *[F.col(f"v.{c}").alias(c) for c in values])


def sessions(events: DataFrame, gap: str = "30 minutes") -> DataFrame:
    """Sessions of a user, ended by a gap."""
    return events.groupBy("user_id", F.session_window("ts", gap).alias("w")).agg(F.count("*").alias("n")).select("user_id", F.col("w.start").alias("start"), F.col("w.end").alias("end"), "n")
