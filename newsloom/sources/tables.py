"""Readers of the engine's tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, at: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{at}/{name}.parquet")


def canonical_id(c: Column | str) -> Column:
    """A message id in lower case without blanks; null and empty ids give null."""
    c = F.col(c) if isinstance(c, str) else c
    return F.nullif(F.lower(F.regexp_replace(c, r"\s+", "")), F.lit(""))


def sender_address(c: Column | str) -> Column:
    """The address in the final angle brackets, else all of the header; lower case, without the `+` suffix of its local part."""
    c = F.col(c) if isinstance(c, str) else c
    inner = F.regexp_extract(c, r"<([^<>]*)>\s*$", 1)
    return F.regexp_replace(F.lower(F.trim(F.when(inner != "", inner).otherwise(c))), r"\+[^@]*@", "@")
