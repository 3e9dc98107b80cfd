"""Writers: exports, archives, idempotent appends."""

from __future__ import annotations

import os
import uuid

import pandas as pd
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from newsloom.functions.text import slug
from newsloom.plans.durable import durable


def _one_line(df: DataFrame) -> DataFrame:
    return df.select(*(F.regexp_replace(F.col(f"`{n}`"), r"\r?\n", " ").alias(n) if t == "string" else F.col(f"`{n}`") for n, t in df.dtypes))


def write_csv(df: DataFrame, path: str) -> None:
    """Always quoted, quotes doubled, one row a line; replaces the folder."""
    _one_line(df).write.mode("overwrite").csv(path, header=True, quoteAll=True, escape='"')


def write_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def write_archive(df: DataFrame, path: str, by: tuple[str, ...] = ("segment", "received_date")) -> None:
    """Parquet by segment and day, sorted inside, so that a look-up reads one folder. The rows of a folder go to as many tasks as
    its size asks for (adaptive execution splits what the rebalance finds large), so a hot day is no single task."""
    df.hint("rebalance", *by).sortWithinPartitions(*by).write.mode("overwrite").partitionBy(*by).parquet(path)


def blob_path(segment: str = "segment", name: str = "sender_name", key: str = "msg_id"):
    """`eml/<segment>/<slug>__<id>.eml`"""
    return F.concat_ws("/", F.lit("eml"), F.col(segment), F.concat(slug(F.col(name)), F.lit("__"), F.col(key), F.lit(".eml")))


def _files(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def replace_table(df: DataFrame, path: str) -> None:
    """A new version written beside the old one, then swapped in: df may read the path that it replaces."""
    spark = df.sparkSession
    new, old = f"{path}.new-{uuid.uuid4().hex}", f"{path}.old-{uuid.uuid4().hex}"
    df.write.parquet(new)
    at, fs = _files(spark, path)
    target, was = spark._jvm.org.apache.hadoop.fs.Path(new), spark._jvm.org.apache.hadoop.fs.Path(old)
    if fs.exists(at):
        fs.rename(at, was)
    fs.rename(target, at)
    fs.delete(was, True)


def publish(df: DataFrame, path: str) -> str:
    """A new version below the path, then one atomic step that makes it the current one: readers (`current`) see the old table or
    the new one, never none. df may read the version that it replaces. Old versions stay until they are removed."""
    spark = df.sparkSession
    version = uuid.uuid4().hex
    df.write.parquet(f"{path}/version={version}")
    jvm = spark._jvm
    at, fs = _files(spark, f"{path}/CURRENT-{version}")
    out = fs.create(at, True)
    out.write(bytearray(version, "ascii"))
    out.close()
    rename = jvm.org.apache.hadoop.fs.Options.Rename
    over = spark.sparkContext._gateway.new_array(rename, 1)
    over[0] = rename.OVERWRITE
    jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark._jsc.hadoopConfiguration()).rename(at, jvm.org.apache.hadoop.fs.Path(f"{path}/CURRENT"), over)
    return version


def current(spark: SparkSession, path: str) -> DataFrame:
    """The version that was published last."""
    version = spark.read.text(f"{path}/CURRENT").first()[0]
    return spark.read.parquet(f"{path}/version={version}")


def write_json_array(df: DataFrame, path: str) -> None:
    """All rows as one JSON array in one file, in the order of the table: a single file, so one task writes it, row by row. Large
    tables are written as lines (`write_json`)."""

    def run(batches):
        first = True
        for b in batches:
            lines = []
            for v in b["value"]:  # the null at the end closes the array
                lines.append(("[]" if first else "]") if v is None else ("[" if first else ",") + v)
                first = False
            yield b.assign(value=lines)

    rows = df.select(F.to_json(F.struct(*(F.col(f"`{c}`") for c in df.columns)), {"ignoreNullFields": "false"}).alias("value"))
    end = df.sparkSession.range(1).select(F.lit(None).cast("string").alias("value"))
    rows.union(end).coalesce(1).mapInPandas(run, "value string").write.mode("overwrite").text(path)


def write_blobs(df: DataFrame, base: str, path: str = "path", content: str = "raw") -> DataFrame:
    """Each content as a file below a folder that every executor mounts; (path, length) of what was written. A file appears whole
    or not at all, and is replaced by a second run. Paths that lead out of the folder are refused; null contents are left out."""

    def run(batches):
        for b in batches:
            for p, data in zip(b["p"], b["c"], strict=True):
                target = os.path.normpath(os.path.join(base, p))
                if not target.startswith(os.path.join(os.path.normpath(base), "")):
                    raise ValueError(f"{p} is not below {base}")
                os.makedirs(os.path.dirname(target), exist_ok=True)
                part = f"{target}.{uuid.uuid4().hex}"
                with open(part, "wb") as f:
                    f.write(data)
                os.replace(part, target)
            yield pd.DataFrame({"path": b["p"], "length": [len(x) for x in b["c"]]})

    rows = df.select(F.col(path).alias("p"), F.col(content).cast("binary").alias("c")).filter("p IS NOT NULL AND c IS NOT NULL")
    return durable(rows.mapInPandas(run, "path string, length long"))


def append_new(batch: DataFrame, path: str, key: str) -> int:
    """Rows whose key is not in the table yet, each key once, appended; returns their number. The table's keys are read once and
    the rows counted as they are written. A second run of the same batch, whole or after a failure, appends nothing twice, so it
    serves as the body of foreachBatch."""
    spark = batch.sparkSession
    at, fs = _files(spark, path)
    once = batch.dropDuplicates([key])
    fresh = once.join(spark.read.parquet(path).select(key), key, "left_anti") if fs.exists(at) else once
    seen = Observation()
    fresh.observe(seen, F.count(F.lit(1)).alias("n")).write.mode("append").parquet(path)
    return int(seen.get["n"])


def append_messages(batch: DataFrame, children: dict[str, DataFrame], base: str, key: str) -> int:
    """Messages that are new with their children, to `base/messages` and a table a name; returns the number of messages.

    Children of a message are written before it, in so far as their message has none yet. A run that fails in between leaves
    children without a message, which the next run completes: a message in its table always has all its children."""
    spark = batch.sparkSession
    at, fs = _files(spark, f"{base}/messages")
    once = batch.dropDuplicates([key])
    fresh = durable(once.join(spark.read.parquet(f"{base}/messages").select(key), key, "left_anti") if fs.exists(at) else once)
    for name, rows in children.items():
        own, there = rows.join(fresh.select(key), key, "left_semi"), _files(spark, f"{base}/{name}")
        if there[1].exists(there[0]):
            own = own.join(spark.read.parquet(f"{base}/{name}").select(key).distinct(), key, "left_anti")
        own.write.mode("append").parquet(f"{base}/{name}")
    return append_new(fresh, f"{base}/messages", key)
