"""Problem 7: processing only new or changed records, with the target itself as the state."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from corpusmill.functions.normal import path_key, sha_key
from corpusmill.session import bounded, materialise, scratch_root

#: Runs up to which their intervals are broadcast.
BROADCAST_RUNS = 50_000
DAY_MS = 86_400_000
#: Parts of a day's rows where runs are too many to broadcast.
SALTS = 64
#: Parts of a target that are rewritten by themselves.
BUCKETS = 64


def run_intervals(runs: DataFrame) -> DataFrame:
    """start, end, ok of each run in epoch milliseconds (end exclusive, null for the last).

    Of runs with one started_at only that with the greatest run_id counts; runs without started_at are left out. A
    run's own row order is small (one row a run), so one window over all runs is fine.
    """
    r = runs.select("run_id", F.col("started_at").cast("timestamp").alias("at"), "status").where("at is not null").groupBy("at").agg(F.max_by("status", F.coalesce("run_id", F.lit(-1))).alias("status"))
    start = F.unix_micros("at")
    w = Window.orderBy("at")
    return r.select(start.alias("start"), F.lead(start).over(w).alias("end"), F.coalesce(F.lower(F.trim("status")) == "ok", F.lit(False)).alias("ok"))


def stored_state(files: DataFrame, runs: DataFrame) -> DataFrame:
    """key, path, sha, mtime: per path the newest cached row that belongs to a successful run.

    A row belongs to the latest run started at or before its indexed_at. The as-of join is an equi-join on the day:
    a run's interval is cut at day boundaries up to the greatest indexed_at; runs are broadcast while they are few.
    Rows without path or indexed_at are left out. Of rows with one indexed_at the greater (mtime, sha) wins.
    """
    f = files.select(path_key(F.col("path")).alias("key"), "path", sha_key(F.col("sha")).alias("sha"), "mtime", "indexed_at").where("key is not null and indexed_at is not null")
    last = f.agg(F.max("indexed_at")).first()[0] or 0
    i = run_intervals(runs)
    end = F.least(F.coalesce(F.col("end"), F.lit((last + 1) * 1000)), F.lit((last + 1) * 1000))
    i = i.withColumn("end", end).where("end > start")
    day = lambda c: F.floor(c / F.lit(DAY_MS * 1000)).cast("bigint")
    i = i.select("start", "end", "ok", F.explode(F.sequence(day(F.col("start")), day(F.col("end") - 1))).alias("day"))
    at, on = F.col("indexed_at") * 1000, ["day"]
    f = f.withColumn("day", day(at))
    if bounded(runs, BROADCAST_RUNS):
        i = F.broadcast(i)
    else:  # rows of one day are spread over SALTS tasks, each with that day's runs
        on = ["day", "salt"]
        f = f.withColumn("salt", F.pmod(F.xxhash64("key"), F.lit(SALTS)))
        i = i.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))).withColumn("salt", F.col("salt").cast("bigint"))
    f = f.join(i, on).where((at >= F.col("start")) & (at < F.col("end")) & F.col("ok"))
    newest = F.struct("indexed_at", F.coalesce("mtime", F.lit(-(1 << 62))).alias("m"), F.coalesce("sha", F.lit("")).alias("s"), "path", "sha", "mtime")
    return f.groupBy("key").agg(F.max(newest).alias("x")).select("key", "x.path", "x.sha", "x.mtime")


def disk_state(scan: DataFrame) -> DataFrame:
    """key, path, sha, mtime: one row per sighted path; sha and mtime of the latest sighting that has both, else null.

    A sighting without seen_at counts as the oldest. Of equal seen_at the greater (mtime, sha) wins.
    """
    s = scan.select(path_key(F.col("path")).alias("key"), sha_key(F.col("sha")).alias("sha"), "mtime", "seen_at").where("key is not null and key <> ''")
    x = F.when(F.col("sha").isNotNull() & F.col("mtime").isNotNull(), F.struct(F.coalesce(F.unix_micros(F.col("seen_at").cast("timestamp")), F.lit(-(1 << 62))).alias("t"), "mtime", "sha"))
    return s.groupBy("key").agg(F.max(x).alias("x")).select("key", F.col("key").alias("path"), "x.sha", "x.mtime")


def pending(source: DataFrame, target: DataFrame, key: str, version: list[str]) -> DataFrame:
    """Source rows whose key and version no target row holds: an anti-join, null-safe on the version."""
    old = target.select(F.col(key).alias("_k"), *(F.col(v).alias(f"_v{i}") for i, v in enumerate(version)))
    on = source[key] == old["_k"]
    for i, v in enumerate(version):
        on = on & source[v].eqNullSafe(old[f"_v{i}"])
    return source.join(old, on, "left_anti")


class ConcurrentRun(RuntimeError):
    """Another run published the version that this one was about to."""


class VersionedTarget:
    """A target table whose rows carry the key and version of the source record they come from: the state of the next run.

    `root/data/<id>/` holds the rows that one run wrote, in folders by bucket of the key's hash; `root/versions/<n>.json`
    names the folder of each bucket, and the highest n counts. A run writes the buckets that change and then its
    version file, under a name that must not exist yet: readers see the old or the new version, never a part; a run
    that fails leaves at most unnamed data; of two runs from one version one is refused. What was published is what
    the rows say, so nothing is done twice or missed. The store must refuse to rename over an existing file, as
    HDFS and local disks do.
    """

    def __init__(self, spark: SparkSession, root: str, key: str, version: list[str], buckets: int = BUCKETS):
        self.spark, self.root, self.key, self.version, self.buckets = spark, root.rstrip("/"), key, version, buckets

    def _fs(self):
        path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        return path(self.root).getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), path

    def versions(self) -> list[int]:
        fs, path = self._fs()
        at = path(f"{self.root}/versions")
        return sorted(int(f.getPath().getName()[:-5]) for f in fs.listStatus(at) if f.getPath().getName().endswith(".json")) if fs.exists(at) else []

    def _folders(self, n: int) -> dict[str, str]:
        """Bucket to folder, relative to root."""
        return json.loads(self.spark.read.text(f"{self.root}/versions/{n:012d}.json", wholetext=True).first()[0])

    def read(self, n: int | None = None) -> DataFrame | None:
        """Rows of version n, of the current one if None; None before the first publication or where no row is left."""
        known = self.versions()
        folders = self._folders(known[-1] if n is None else n) if known else {}
        return self.spark.read.option("mergeSchema", "true").parquet(*(f"{self.root}/{f}" for f in sorted(folders.values()))) if folders else None

    def _bucket(self):
        return F.pmod(F.xxhash64(self.key), F.lit(self.buckets)).cast("int")

    def pending(self, source: DataFrame) -> DataFrame:
        """Source rows that the target does not hold in their version."""
        old = self.read()
        return source if old is None else pending(source, old, self.key, self.version)

    def gone(self, keys: DataFrame) -> DataFrame | None:
        """Target rows whose key is not among `keys`; None if there is no target yet."""
        old = self.read()
        return None if old is None else old.join(keys.select(F.col(self.key).alias("_k")).distinct(), F.col(self.key) == F.col("_k"), "left_anti")

    def adopt(self, rows: DataFrame) -> int:
        """Publish rows that were made elsewhere as the next version, in place of all there are."""
        known = self.versions()
        return self._publish(known[-1] if known else 0, {}, self._write(rows))

    def run(self, source: DataFrame, process: Callable[[DataFrame], DataFrame], before_publishing: Callable[[], None] | None = None) -> int:
        """Process what is pending, drop rows of keys that are gone or changed, publish; returns the version that counts then.

        Only the buckets of such keys are read and written again; if nothing changed, nothing is published. `process`
        must keep the key and version columns; rows it leaves out are pending again in the next run. Rows without key
        are ignored. `before_publishing` is called when all is written, for checks that may still refuse it.
        """
        known = self.versions()
        base = known[-1] if known else 0
        source = source.where(F.col(self.key).isNotNull())
        todo = materialise(self.pending(source), "pending").withColumn("_bucket", self._bucket())
        old = self.read(base) if known else None
        touched = todo.select("_bucket").distinct()
        if old is not None:
            stale = materialise(pending(old, source, self.key, self.version).select(self.key, *self.version), "stale")
            touched = touched.unionByName(stale.select(self._bucket().alias("_bucket"))).distinct()
        touched = sorted(r[0] for r in touched.collect())  # no more than there are buckets
        if known and not touched:
            return base
        new = process(todo.drop("_bucket"))
        if old is not None:
            kept = old.where(self._bucket().isin(touched))
            new = pending(kept, stale, self.key, self.version).unionByName(new, allowMissingColumns=True)
        made = self._write(new)
        if before_publishing:
            before_publishing()
        stay = {b: f for b, f in self._folders(base).items() if int(b) not in touched} if known else {}
        return self._publish(base, stay, made)

    def _write(self, rows: DataFrame) -> dict[str, str]:
        folder = f"data/{uuid.uuid4().hex}"
        rows.withColumn("_bucket", self._bucket()).repartition("_bucket").write.partitionBy("_bucket").parquet(f"{self.root}/{folder}")
        fs, path = self._fs()
        made = (f.getPath().getName() for f in fs.listStatus(path(f"{self.root}/{folder}")))
        return {n.partition("=")[2]: f"{folder}/{n}" for n in made if n.startswith("_bucket=")}

    def _publish(self, base: int, stay: dict[str, str], made: dict[str, str]) -> int:
        fs, path = self._fs()
        own, name = path(f"{self.root}/versions/.{uuid.uuid4().hex}"), path(f"{self.root}/versions/{base + 1:012d}.json")
        fs.mkdirs(path(f"{self.root}/versions"))
        out = fs.create(own, True)
        out.write(bytearray(json.dumps(stay | made).encode()))
        out.close()
        jvm = self.spark.sparkContext._jvm
        files = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), self.spark.sparkContext._jsc.hadoopConfiguration())
        try:
            files.rename(own, name, self.spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0))
        except Py4JJavaError as e:
            if fs.exists(name):
                raise ConcurrentRun(f"version {base + 1} of {self.root} is published already") from e
            raise
        finally:
            fs.delete(own, False)
        return base + 1

    def vacuum(self, keep: int = 2) -> int:
        """Delete version files but the last `keep`, and data that none of those names; returns how many folders went. Not while a run writes."""
        known = self.versions()
        used = {f.rpartition("/")[0] for n in known[-keep:] for f in self._folders(n).values()}
        fs, path = self._fs()
        gone = 0
        for n in known[:-keep]:
            fs.delete(path(f"{self.root}/versions/{n:012d}.json"), False)
        at = path(f"{self.root}/data")
        for f in fs.listStatus(at) if fs.exists(at) else []:
            if f"data/{f.getPath().getName()}" not in used:
                gone += bool(fs.delete(f.getPath(), True))
        return gone


def cache_target(files: DataFrame, runs: DataFrame) -> VersionedTarget:
    """A target in the shared folder that holds what successful runs stored: key, path and the version sha, mtime."""
    spark = files.sparkSession
    target = VersionedTarget(spark, f"{scratch_root(spark)}/target-{uuid.uuid4().hex}", "key", ["sha", "mtime"], 16)
    target.adopt(stored_state(files, runs))
    return target


def changes(files: DataFrame, runs: DataFrame, scan: DataFrame) -> DataFrame:
    """path, change_kind, sha, mtime of each path to process.

    added: on disk, nothing stored; modified: sha or mtime differs (a stored null differs from a value); deleted:
    stored and never sighted. A path sighted only without sha or mtime has no known state on disk: it is neither
    deleted nor modified nor added. path is as in `files` where it is stored, else in normal notation; sha and mtime
    are those on disk. Empty tables give no rows.

    What is stored is a versioned target. What it lacks of the disk is an anti-join on key and version, and what it has
    beyond the disk an anti-join on the key; only rows that differ are looked up once more to tell their kind.
    """
    target, seen = cache_target(files, runs), disk_state(scan)
    todo = target.pending(seen.where("sha is not null"))
    held = target.read()
    if held is None:
        return todo.select("path", F.lit("added").alias("change_kind"), "sha", "mtime")
    todo = todo.join(held.select(F.col("key").alias("_k"), F.col("path").alias("stored")), F.col("key") == F.col("_k"), "left")
    kind = F.when(F.col("stored").isNull(), "added").otherwise("modified")
    todo = todo.select(F.coalesce("stored", "path").alias("path"), kind.alias("change_kind"), "sha", "mtime")
    none = lambda c: F.lit(None).cast(seen.schema[c].dataType).alias(c)
    return todo.unionByName(target.gone(seen).select("path", F.lit("deleted").alias("change_kind"), none("sha"), none("mtime")))


def next_state(files: DataFrame, runs: DataFrame, scan: DataFrame) -> DataFrame:
    """key, path, sha, mtime as stored after the next run, which fails once when all is written and is then repeated.

    Paths on disk have their state there, paths sighted only without sha or mtime keep what is stored, the rest are gone.
    """
    target, seen = cache_target(files, runs), disk_state(scan)
    held, known = target.read(), seen.where("sha is not null")
    source = known
    if held is not None:
        kept = held.join(seen.where("sha is null").select(F.col("key").alias("_k")), F.col("key") == F.col("_k"), "left_semi")
        source = known.unionByName(kept.select("key", "path", "sha", "mtime"))

    def fail() -> None:
        raise InterruptedError("the run ends here")

    try:
        target.run(source, lambda rows: rows, fail)
    except InterruptedError:
        pass
    target.run(source, lambda rows: rows)
    out = target.read()
    return source if out is None else out.select("key", "path", "sha", "mtime")
