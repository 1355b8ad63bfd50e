"""Reading corpora of Markdown and YAML files, front-matter, JSON indexes and commit logs; writing indexes."""

from __future__ import annotations

import json
import re

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType

# Folders that hold no documents, and fields of a commit record.
SKIPPED = ("node_modules", "dist", "build", "coverage")
COMMIT = ("sha", "author", "email", "date", "subject", "body")


def read_files(spark: SparkSession, root: str, suffixes: tuple[str, ...] = ("md", "yaml", "yml"), skipped: tuple[str, ...] = SKIPPED) -> DataFrame:
    """path (relative to root), text, mtime (epoch ms), size of the files under `root`; hidden and generated folders are left out.

    Listing is Spark's own; the suffix reaches the listing, the rest is a filter on the path before files are read.
    """
    f = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.{" + ",".join(suffixes) + "}").load(root)
    base = root.rstrip("/").removeprefix("file://") + "/"
    rel = F.regexp_extract("path", "^(?:[a-z0-9]+:/+(?=/))?.*?" + _quote(base) + "(.*)$", 1)
    hidden = rel.rlike(r"(^|/)\.|(^|/)(" + "|".join(skipped) + ")/")
    return f.where(~hidden).select(rel.alias("path"), F.col("content").cast("string").alias("text"), F.unix_millis("modificationTime").alias("mtime"), F.col("length").alias("size"))


def _quote(s: str) -> str:
    return "\\Q" + s + "\\E"


def front_matter(text: Column) -> Column:
    """The YAML between the first two lines of `---`, null if there is none."""
    m = F.regexp_extract(text, r"(?s)\A\x{FEFF}?---[ \t]*\r?\n(.*?)\r?\n---[ \t]*(?:\r?\n|\z)", 1)
    return F.when(m != "", m)


def body(text: Column) -> Column:
    """The text after the front-matter, all of it if there is none."""
    return F.regexp_replace(text, r"(?s)\A\x{FEFF}?---[ \t]*\r?\n.*?\r?\n---[ \t]*(?:\r?\n|\z)", "")


@F.pandas_udf(StringType())
def yaml_json(text: pd.Series) -> pd.Series:
    """JSON of a YAML document; null for null or malformed YAML. Fails where no YAML library is installed."""
    import yaml

    def convert(t: str) -> str | None:
        try:
            return json.dumps(yaml.safe_load(t), default=str)
        except yaml.YAMLError:
            return None

    return text.map(convert, na_action="ignore")


def read_strands(spark: SparkSession, root: str) -> DataFrame:
    """path, metadata (JSON, null without front-matter), text (body), mtime, size of the Markdown files under `root`."""
    f = read_files(spark, root, ("md",))
    return f.select("path", yaml_json(front_matter(F.col("text"))).alias("metadata"), body(F.col("text")).alias("text"), "mtime", "size")


def header_kept(text: Column) -> Column:
    """The YAML of a header that begins with the first character, by its lines of `---` alone; for readers that go on with the whole text, header included. Null if there is none."""
    m = F.regexp_extract(text, r"(?s)\A---\n(.*?)\n---", 1)
    return F.when(m != "", m)


def with_header(text: Column, metadata: Column) -> Column:
    """The text with `metadata` (JSON, which is YAML) as its front-matter in place of its own; unchanged where that is null.

    Sources are not written to: the result goes to a table or folder of its own.
    """
    return F.when(metadata.isNull(), text).otherwise(F.concat(F.lit("---\n"), metadata, F.lit("\n---\n"), body(text)))


def write_files(df: DataFrame, root: str) -> None:
    """Each row's `text` as the file `path` under `root`, which must be a folder that all executors reach; written by the tasks.

    A file is written beside its place and renamed into it, so a repeated task leaves one whole file. A path that
    leaves `root` fails. Rows without path or text are left out; of rows with one path any may stay.
    """
    base = root.removeprefix("file://")

    def put(rows) -> None:
        import os
        import uuid

        for r in rows:
            at = os.path.normpath(os.path.join(base, r["path"]))
            if not at.startswith(os.path.normpath(base) + os.sep):
                raise ValueError(f"{r['path']} leaves {root}")
            os.makedirs(os.path.dirname(at), exist_ok=True)
            with open(f"{at}.{uuid.uuid4().hex}", "w", encoding="utf-8", newline="") as f:
                f.write(r["text"])
            os.replace(f.name, at)

    df.select("path", "text").where("path is not null and text is not null").foreachPartition(put)


def read_yaml(spark: SparkSession, root: str, name: str | None = None) -> DataFrame:
    """path, text, metadata (JSON, null if malformed), mtime, size of the YAML files under `root`, or of those of one name, such as the descriptions of weaves and looms."""
    f = read_files(spark, root, ("yaml", "yml"))
    f = f if name is None else f.where(F.regexp_extract("path", "[^/]*$", 0) == name)
    return f.select("path", "text", yaml_json("text").alias("metadata"), "mtime", "size")


def strand_template(title: str, identifier: str) -> str:
    """A new document's text: front-matter with id, slug, title and version, and a heading."""
    name = re.sub("[^a-z0-9]+", "-", title.lower())
    return f'---\nid: {identifier}\nslug: {name}\ntitle: {json.dumps(title)}\nversion: 1.0.0\ncontentType: markdown\ndifficulty: beginner\ntags: []\n---\n\n# {title}\n'


def read_index(spark: SparkSession, path: str) -> DataFrame:
    """Rows of a JSON array; ValueError if it is missing, no array, or empty."""
    try:
        df = spark.read.option("multiLine", "true").json(path)
        bad = not df.columns or df.columns == ["_corrupt_record"] or df.isEmpty()
    except Exception as e:
        raise ValueError(f"{path}: cannot be read as a JSON array") from e
    if bad:
        raise ValueError(f"{path}: not a JSON array of objects, or empty")
    return df


def read_commits(spark: SparkSession, path: str) -> DataFrame:
    """sha, author, email, date, subject, body of a log whose fields end with NUL and whose records end with the byte 0x1e, so a body may hold line ends."""
    t = spark.read.option("lineSep", "\x1e").text(path).where("trim(value) <> ''")
    p = F.split(F.regexp_replace("value", r"^\s+", ""), "\u0000")
    return t.select(*(F.get(p, i).alias(c) for i, c in enumerate(COMMIT)))


def write_json(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """JSON lines, one file per partition."""
    df.write.mode(mode).json(path)


def write_document(df: DataFrame, path: str, **fields: object) -> None:
    """One JSON document: the given fields, and the rows as the list `entries`. Rows stream through the driver, which holds one partition at a time."""
    with open(path.removeprefix("file://"), "w", encoding="utf-8") as f:
        f.write(json.dumps(fields, default=str)[:-1] + (", " if fields else "") + '"entries": [')
        for i, r in enumerate(df.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"})).toLocalIterator()):
            f.write(("," if i else "") + r[0])
        f.write("]}")


def write_cache(df: DataFrame, path: str, table: str) -> None:
    """The rows as one table of an SQLite file, in place of that table; for one machine's tools. Arrays and structs become JSON. Rows stream through the driver."""
    import sqlite3

    kinds = {"bigint": "INTEGER", "int": "INTEGER", "boolean": "INTEGER", "double": "REAL", "float": "REAL"}
    plain = [F.to_json(c).alias(c) if t.startswith(("array", "struct", "map")) else F.col(c) for c, t in df.dtypes]
    db = sqlite3.connect(path)
    try:
        with db:  # all or nothing
            db.execute(f'drop table if exists "{table}"')
            db.execute(f'create table "{table}" ({", ".join(f"{chr(34)}{c}{chr(34)} {kinds.get(t, "TEXT")}" for c, t in df.dtypes)})')
            db.executemany(f'insert into "{table}" values ({", ".join("?" * len(df.columns))})', (tuple(r) for r in df.select(*plain).toLocalIterator()))
    finally:
        db.close()


def write_table(df: DataFrame, path: str, by: tuple[str, ...] = (), mode: str = "overwrite") -> None:
    """Parquet, partitioned by `by`: rows of one value go to few files, and a hot value to several."""
    w = df
    if by:
        w = df.withColumn("_salt", F.pmod(F.xxhash64(*df.columns[:1]), F.lit(16))).repartition(*by, "_salt").drop("_salt")
    (w.write.mode(mode).partitionBy(*by) if by else w.write.mode(mode)).parquet(path)


def read_cache(spark: SparkSession, path: str, table: str) -> DataFrame:
    """One table of an SQLite cache. The file is one machine's cache, so rows come through the driver in blocks of 50,000."""
    import sqlite3

    db = sqlite3.connect(path)
    try:
        kinds = {"INTEGER": "bigint", "REAL": "double"}
        schema = ", ".join(f"`{r[1]}` {kinds.get(r[2].upper(), 'string')}" for r in db.execute(f'pragma table_info("{table}")'))
        cursor, out = db.execute(f'select * from "{table}"'), spark.createDataFrame([], schema)
        while rows := cursor.fetchmany(50_000):
            out = out.unionByName(spark.createDataFrame(rows, schema))
        return out
    finally:
        db.close()
