"""Session settings, table access and scratch space on the cluster's shared folder."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Above this estimated size in bytes a side is never broadcast on request.
BROADCAST_BYTES = 64 << 20


def session(app: str = "corpusmill", master: str | None = None, partitions: int | None = None) -> SparkSession:
    """A session with UTC, AQE and Arrow on. `master` None leaves it to spark-submit."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    b = (
        b.config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.ui.enabled", "false")
    )
    if partitions:
        b = b.config("spark.sql.shuffle.partitions", str(partitions))
    return b.getOrCreate()


def table(spark: SparkSession, directory: str, name: str) -> DataFrame:
    """The Parquet table `name` of `directory` (a file or a folder of files)."""
    return spark.read.parquet(f"{directory}/{name}.parquet")


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """`df` in at least as many partitions as there are cores.

    For narrow work that takes long per row. A small file is one partition and would keep one core busy; input that
    already has a partition for each core - any of more than some hundred MB - is left as it is, without a shuffle.
    With `keys` rows are placed by their hash, so that groupings by them, or by them and more, need no further shuffle.
    """
    n = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(n, *keys) if df._jdf.queryExecution().toRdd().getNumPartitions() < n else df


def wide(df: DataFrame, *keys: str) -> DataFrame:
    """`df` hashed by `keys` into as many partitions as a shuffle has, at least one per core.

    For a shuffle that slow per-row work follows: the adaptive planner merges small shuffle partitions by their bytes,
    which would leave cores idle. A grouping or join on the same keys needs no further shuffle.
    """
    spark = df.sparkSession
    return df.repartition(max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism), *keys)


def scratch_root(spark: SparkSession) -> str:
    """The shared folder of spark.checkpoint.dir; only where that is unset, a local folder for tests on one machine."""
    conf = spark.sparkContext.getConf().get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    if conf:
        return conf.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    folder = os.path.join(tempfile.gettempdir(), "corpusmill-" + spark.sparkContext.applicationId)
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    spark.conf.set("spark.checkpoint.dir", f"file://{folder}")
    return f"file://{folder}"


_written: list[str] = []


def materialise(df: DataFrame, name: str = "table") -> DataFrame:
    """Write `df` to the shared folder and read it back: cuts lineage, survives lost executors, stays columnar."""
    spark = df.sparkSession
    path = f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    _written.append(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_scratch(spark: SparkSession) -> int:
    """Delete every table that materialise() wrote in this process; returns how many. Call once their readers are done."""
    jvm, conf, n = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration(), 0
    while _written:
        path = jvm.org.apache.hadoop.fs.Path(_written.pop())
        n += bool(path.getFileSystem(conf).delete(path, True))
    return n


def bounded(df: DataFrame, rows: int) -> bool:
    """Whether `df` has at most `rows` rows; reads no more than rows + 1 of them."""
    return df.limit(rows + 1).count() <= rows
