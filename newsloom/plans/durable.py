"""Lineage cuts that survive the loss of an executor, and joins that survive hot keys."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: A key is hot when it holds more than one row in HOT_PARTS; so at most HOT_PARTS keys can be hot.
HOT_PARTS = 1000


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder of the session; a local one is made only where the session names none and runs on one machine (tests).
    On a cluster without one this is an error, as executors could not read each other's files."""
    for get in (lambda: spark.conf.get("spark.checkpoint.dir", None), lambda: spark.sparkContext.getConf().get("spark.checkpoint.dir"), spark.sparkContext.getCheckpointDir):
        if found := get():
            return found
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    made = "file://" + tempfile.mkdtemp(prefix="newsloom-")
    spark.sparkContext.setCheckpointDir(made)
    return made


def _remove(spark: SparkSession, path: str) -> None:
    try:
        jvm = spark._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)
    except Exception:  # the session has already ended
        pass


def durable(df: DataFrame) -> DataFrame:
    """df, written once to the shared folder as Parquet and read back: no task of a later stage recomputes it,
    and its files give the optimiser a true size. The files go when the driver ends."""
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/newsloom/{uuid.uuid4().hex}"
    atexit.register(_remove, spark, path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def hot_threshold(total: int, parts: int = HOT_PARTS) -> int:
    """Rows above which a key is hot; no more than `parts` keys can exceed it."""
    return max(1, total // parts)


def join_counted(rows: DataFrame, keyed: DataFrame, key: str | list[str], count_col: str, total: int, how: str = "inner") -> DataFrame:
    """rows joined with keyed, which has one row per key and the number of rows of the key (or a bound on it) in count_col.

    Hot keys (at most HOT_PARTS by arithmetic, so that bound is proven) are broadcast and never shuffled; all other keys
    are joined by a shuffle in which no key holds more than 1/HOT_PARTS of the rows. A left anti join keeps the rows without a
    key in keyed, of which no more than one in HOT_PARTS may be alike.
    """
    edge = hot_threshold(total)
    hot, cold = keyed.filter(F.col(count_col) > edge), keyed.filter(F.col(count_col) <= edge)
    names = F.broadcast(hot.select(*([key] if isinstance(key, str) else key)))
    rest = rows.join(names, key, "left_anti")
    if how == "left_anti":
        return rest.join(cold, key, how)
    return rows.join(F.broadcast(hot), key, how).unionByName(rest.join(cold, key, how))
