"""Activity logs: daily and monthly roll-ups and the append-only log without repeats."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def daily(events: DataFrame, ts: str = "ts", kind: str = "event_type") -> DataFrame:
    """month, date, type, n, total of each day and type; total is over all types of the day."""
    e = events.where(F.col(ts).isNotNull()).select(F.to_date(ts).alias("date"), F.col(kind).alias("type"))
    by = e.groupBy("date", "type").agg(F.count("*").alias("n"))
    total = by.groupBy("date").agg(F.sum("n").alias("total"))
    return by.join(total, "date").select(F.date_format("date", "yyyy-MM").alias("month"), "date", "type", "n", "total")


def monthly(events: DataFrame, ts: str = "ts", kind: str = "event_type") -> DataFrame:
    """month, by_type (map of type to n), days, n."""
    e = events.where(F.col(ts).isNotNull()).select(F.date_format(ts, "yyyy-MM").alias("month"), F.to_date(ts).alias("date"), F.coalesce(kind, F.lit("other")).alias("type"))
    by = e.groupBy("month", "type").agg(F.count("*").alias("n"))
    days = e.groupBy("month").agg(F.count_distinct("date").alias("days"))
    return by.groupBy("month").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("type", "n")))).alias("by_type"), F.sum("n").alias("n")).join(days, "month")


def unseen(new: DataFrame, log: DataFrame, key: tuple[str, ...] = ("date", "type")) -> DataFrame:
    """Rows of `new` whose (date, type) the log lacks. Late rows of another type of a recorded day are kept."""
    return new.join(log.select(*key).distinct(), list(key), "left_anti")


def summary(events: DataFrame, kinds: dict[str, Column]) -> DataFrame:
    """date and a count for each named condition, with the total; days without any are left out."""
    d = events.where("ts is not null").groupBy(F.to_date("ts").alias("date")).agg(*(F.count_if(c).alias(n) for n, c in kinds.items()))
    total = sum((F.col(n) for n in kinds), F.lit(0))
    return d.withColumn("total", total.cast("bigint")).where("total > 0")


def append_months(new: DataFrame, directory: str, key: tuple[str, ...] = ("date", "type")) -> int:
    """Append the unseen rows to JSON lines partitioned by month; returns how many. Malformed lines of the log are skipped."""
    from corpusmill.session import materialise

    spark = new.sparkSession
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(directory)
    if path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path):
        log = spark.read.schema(new.select(*key).schema).option("mode", "DROPMALFORMED").json(directory)
        new = unseen(new, log, key)
    new = materialise(new, "unseen")
    n = new.count()
    if n:
        new.withColumn("_month", F.date_format("date", "yyyy-MM")).write.mode("append").partitionBy("_month").json(directory)
    return n
