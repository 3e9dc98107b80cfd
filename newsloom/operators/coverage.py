"""Stories as groups of equal items, and how many distinct sources cover each."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import window as W

from newsloom.functions.text import content_hash


def members(items: DataFrame, key: str, source: str, text: str) -> DataFrame:
    """(cluster_id, key, source): every item with a text, none discarded. Items of one cluster have the same text up to blanks."""
    norm = F.trim(F.regexp_replace(text, r"\s+", " "))
    return items.filter(norm != "").select(content_hash(norm).alias("cluster_id"), key, source)


def coverage(member: DataFrame, key: str, source: str, brand: Column | None = None) -> DataFrame:
    """(cluster_id, coverage_n, size, first_id, sources): distinct sources or, where brand is given, distinct brands."""
    counted = F.col(source) if brand is None else brand
    return member.groupBy("cluster_id").agg(
        F.count_distinct(counted).alias("coverage_n"), F.count(F.lit(1)).alias("size"), F.min(key).alias("first_id"), F.array_sort(F.collect_set(source)).alias("sources")
    )


def roster(items: DataFrame, source: str) -> DataFrame:
    """(roster_pos, source): the distinct sources in order. The roster is a dimension, one row per source."""
    names = items.select(source).filter(F.col(source).isNotNull()).distinct()
    return names.select(F.row_number().over(W.Window.orderBy(source)).cast("long").alias("roster_pos"), source)


def strip(clusters: DataFrame, places: DataFrame, source: str) -> DataFrame:
    """clusters with `strip`: one sign for each place of the roster, filled where the place covers the story."""
    order = places.agg(F.array_sort(F.collect_list(F.struct("roster_pos", source))).alias("r")).scalar()
    named = clusters.withColumn("r", order).withColumn("strip", F.array_join(F.transform("r", lambda x: F.when(F.array_contains("sources", x[source]), "■").otherwise("□")), ""))
    return named.withColumn("roster_n", F.size("r").cast("long")).drop("r")


def quiet(places: DataFrame, member: DataFrame, clusters: DataFrame, source: str, least: int = 2) -> DataFrame:
    """Places of the roster that cover no story that at least `least` sources cover."""
    busy = member.join(clusters.filter(F.col("coverage_n") >= least).select("cluster_id"), "cluster_id", "left_semi").select(source).distinct()
    return places.join(busy, source, "left_anti")
