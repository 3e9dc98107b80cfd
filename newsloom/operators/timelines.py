"""As-of joins, range joins with windows, gaps and silences, without a task per hot key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import window as W


def as_of(left: DataFrame, right: DataFrame, key: str, ts: str, value: str, block: str = "day") -> DataFrame:
    """left with `value` of the last row of right at or before its time (same key), and its time as `<value>_ts`.

    Rows are cut into blocks of time; the last value of each block is carried on over the few blocks of a key, so that the
    window inside a block never holds a whole key. Of rows of right at one instant the largest value counts; null times match
    nothing.
    """
    cut = lambda d: d.withColumn("_b", F.date_trunc(block, ts))
    r = cut(right.filter(F.col(ts).isNotNull()).groupBy(key, ts).agg(F.max(value).alias("_v")))
    cols = left.columns
    rows = cut(left).select(key, ts, "_b", F.lit(1).alias("_side"), F.struct(*(f"`{c}`" for c in cols)).alias("_row"), F.lit(None).cast(f"struct<t:{right.schema[ts].dataType.simpleString()},v:{right.schema[value].dataType.simpleString()}>").alias("_hit"))
    row_type = rows.schema["_row"].dataType
    hits = r.select(key, ts, "_b", F.lit(0).alias("_side"), F.lit(None).cast(row_type).alias("_row"), F.struct(F.col(ts).alias("t"), F.col("_v").alias("v")).alias("_hit"))
    both = rows.unionByName(hits)
    last = both.groupBy(key, "_b").agg(F.max_by("_hit", F.when(F.col("_hit").isNotNull(), F.col(ts))).alias("_last"))
    carried = last.select(key, "_b", F.last("_last", ignorenulls=True).over(W.Window.partitionBy(key).orderBy("_b").rowsBetween(W.Window.unboundedPreceding, -1)).alias("_before"))
    inside = W.Window.partitionBy(key, "_b").orderBy(ts, "_side").rowsBetween(W.Window.unboundedPreceding, 0)
    found = both.withColumn("_in", F.last("_hit", ignorenulls=True).over(inside)).filter("_side = 1")
    found = found.join(carried, (found[key].eqNullSafe(carried[key])) & (found["_b"].eqNullSafe(carried["_b"])), "left").select("_row", F.coalesce("_in", "_before").alias("_hit"))
    return found.select("_row.*", F.col("_hit.v").alias(value), F.col("_hit.t").alias(f"{value}_ts"))


def in_windows(rows: DataFrame, windows: DataFrame, ts: str, start: str, end: str) -> DataFrame:
    """Rows with the windows that hold them, [start, end). The windows, one a run or edition, are a small dimension; they are
    cut into days so that the join has an equality and stays a hash join whatever their number."""
    cut = windows.withColumn("_d", F.explode(F.sequence(F.to_date(start), F.to_date(end))))
    return rows.withColumn("_d", F.to_date(ts)).join(cut, "_d").filter((F.col(ts) >= F.col(start)) & (F.col(ts) < F.col(end))).drop("_d")


def gaps(rows: DataFrame, key: str, day: Column) -> DataFrame:
    """(key, arrivals, first_day, last_day, longest_gap, mean_gap) over the distinct days of each key."""
    days = rows.select(key, day.alias("d")).filter(F.col("d").isNotNull()).distinct()
    before = F.datediff("d", F.lag("d").over(W.Window.partitionBy(key).orderBy("d")))
    g = days.withColumn("g", before)
    return g.groupBy(key).agg(F.count(F.lit(1)).alias("arrivals"), F.min("d").alias("first_day"), F.max("d").alias("last_day"), F.max("g").cast("long").alias("longest_gap"), F.round(F.avg("g"), 6).alias("mean_gap"))
