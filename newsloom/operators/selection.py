"""Scores, ranks, slots and quotas."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import window as W

from newsloom.plans.durable import durable

# Weights of the parts of a score.
WEIGHTS = {"coverage_norm": 0.40, "relevance": 0.25, "freshness": 0.15, "source_quality": 0.10, "split_bonus": 0.10}


def score(penalty: Column | float = 0.0, **parts: Column) -> Column:
    """One weighted sum; missing or null parts count as zero."""
    total = F.lit(0.0)
    for name, weight in WEIGHTS.items():
        if name in parts:
            total = total + weight * F.coalesce(parts[name], F.lit(0.0))
    return total - penalty


def relevance(rating: Column) -> Column:
    """A rating from 1 to 10 as 0 to 1; 5 where there is none."""
    return (F.coalesce(rating, F.lit(5.0)) - 1) / 9


def freshness(age_days: Column, window_days: int) -> Column:
    """1 for the newest, falling to 0 at the end of the window."""
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), 1 - age_days / window_days))


def top_per(rows: DataFrame, by: str, order: list[Column], n: int = 1) -> DataFrame:
    """The first n rows of each group, with their rank; the order must be total. Spark prunes each task's groups to n rows
    before the shuffle, so no task holds a whole group."""
    return rows.withColumn("rank", F.row_number().over(W.Window.partitionBy(by).orderBy(*order))).filter(F.col("rank") <= n)


def numbered(rows: DataFrame, by: str, day: str, key: str, number: str) -> DataFrame:
    """rows with their running number in each group, by day and key. Days are counted first and their counts summed up, so a
    task ranks one day of a group, never a whole group."""
    per = rows.groupBy(by, day).agg(F.count(F.lit(1)).alias("_n"))
    before = F.coalesce(F.sum("_n").over(W.Window.partitionBy(by).orderBy(day).rowsBetween(W.Window.unboundedPreceding, -1)), F.lit(0))
    starts = per.select(by, day, before.alias("_start"))
    inside = F.row_number().over(W.Window.partitionBy(by, day).orderBy(key))
    return rows.withColumn("_r", inside).join(starts, [by, day]).withColumn(number, F.col("_start") + F.col("_r")).drop("_r", "_start")


def placed(rows: DataFrame, order: list[Column], place: str) -> DataFrame:
    """rows with their place in a total order over the whole table: sorted by ranges, counted by range, numbered inside each."""
    cut = durable(rows.orderBy(*order).withColumn("_part", F.spark_partition_id()).withColumn("_at", F.monotonically_increasing_id()))
    sizes = cut.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"), F.min("_at").alias("_first"))  # one row a range
    before = F.coalesce(F.sum("_n").over(W.Window.orderBy("_part").rowsBetween(W.Window.unboundedPreceding, -1)), F.lit(0))
    starts = sizes.select("_part", "_first", before.alias("_start"))
    return cut.join(F.broadcast(starts), "_part").withColumn(place, F.col("_start") + F.col("_at") - F.col("_first") + 1).drop("_part", "_at", "_first", "_start")


def slots(ranked: DataFrame, template: list[tuple[str, int]], order: list[Column]) -> DataFrame:
    """The best rows dealt to the slots in turn: quotas in order of priority, a short slot filled from the next rows."""
    total = sum(n for _, n in template)
    first = ranked.orderBy(*order).limit(total).withColumn("place", F.row_number().over(W.Window.orderBy(*order)))
    slot, at = F.lit(None).cast("string"), 0
    for name, n in template:
        slot = F.when((F.col("place") > at) & (F.col("place") <= at + n), name).otherwise(slot)
        at += n
    return first.withColumn("slot", slot)


def share(rows: DataFrame, by: str) -> DataFrame:
    """(by, n, share): counts and their share of all rows."""
    counts = rows.groupBy(by).agg(F.count(F.lit(1)).alias("n"))
    return counts.withColumn("share", F.round(F.col("n") / F.sum("n").over(W.Window.partitionBy(F.lit(1))), 6))
