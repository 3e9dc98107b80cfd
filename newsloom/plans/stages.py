"""Stages of a run that are written as they end, so that a run can go on from the stage that failed."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession

Stage = tuple[str, Callable[[DataFrame | None], DataFrame]]


def _exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def run(spark: SparkSession, stages: Sequence[Stage], base: str, from_stage: str | None = None) -> DataFrame:
    """The last stage's result. Each stage takes the result of the one before it and is written below `base`; what an earlier run
    has written whole is read, not run again. From `from_stage` on everything runs anew.

    A stage that fails leaves no marker of success, so the next run begins with it."""
    names = [n for n, _ in stages]
    if len(set(names)) != len(names) or (from_stage is not None and from_stage not in names) or not names:
        raise ValueError(f"stages {names}, from {from_stage}")
    fresh, last = False, None
    for name, step in stages:
        path = f"{base.rstrip('/')}/{name}"
        fresh = fresh or name == from_stage or not _exists(spark, path)
        if fresh:
            step(last).write.mode("overwrite").parquet(path)
        last = spark.read.parquet(path)
    return last
