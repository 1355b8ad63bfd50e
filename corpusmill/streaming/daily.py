"""Structured Streaming forms of the daily roll-up and the append-only log."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from corpusmill.operators.activity import append_months
from corpusmill.session import scratch_root, table


def event_stream(spark: SparkSession, directory: str, name: str = "events") -> DataFrame:
    """The files of one table as a stream; the schema is that of the files now there."""
    return spark.readStream.schema(table(spark, directory, name).schema).option("pathGlobFilter", f"{name}*.parquet").parquet(directory)


def by_day(events: DataFrame, late: str = "2 days") -> DataFrame:
    """window, type, n with a watermark: rows later than `late` behind the newest are dropped, state of older days is freed."""
    return events.where("ts is not null").withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", late).groupBy(F.window("ts", "1 day").alias("w"), F.col("event_type").alias("type")).agg(F.count("*").alias("n"))


def daily_stream(spark: SparkSession, directory: str) -> DataFrame:
    """date, type, n: everything now there, in as many micro-batches as needed; each batch replaces the days it changes.

    The sink is idempotent: a batch writes its days to a folder named by the batch id, overwriting a failed attempt,
    and the newest row of a day counts.
    """
    root = f"{scratch_root(spark)}/stream-{uuid.uuid4().hex}"

    def put(batch: DataFrame, number: int) -> None:
        batch.select(F.to_date("w.start").alias("date"), "type", "n", F.lit(number).alias("batch")).write.mode("overwrite").parquet(f"{root}/out/batch={number}")

    q = by_day(event_stream(spark, directory)).writeStream.outputMode("update").foreachBatch(put).option("checkpointLocation", f"{root}/checkpoint").trigger(availableNow=True).start()
    q.awaitTermination()
    out = spark.read.option("basePath", f"{root}/out").schema("date date, type string, n bigint, batch int").parquet(f"{root}/out/*")
    return out.groupBy("date", "type").agg(F.max_by("n", "batch").alias("n"))


def append_stream(events: DataFrame, directory: str, checkpoint: str):
    """Daily counts appended to the monthly log as they become final; a day and type already there is not appended again."""

    def put(batch: DataFrame, _: int) -> None:
        append_months(batch.select(F.to_date("w.start").alias("date"), "type", "n"), directory)

    return by_day(events).writeStream.outputMode("append").foreachBatch(put).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
