"""Queries over the mailbox: one instant per message, one row per message."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newsloom.functions.instants import instant_us
from newsloom.operators import deliveries
from newsloom.sources.tables import canonical_id, table


def message_instants(spark: SparkSession, rows: DataFrame, key: str = "msg_id", date: str = "date_h") -> DataFrame:
    """One UTC instant per message, over all its deliveries; (key, utc_us).

    Deliveries may write the instant differently. A message is listed if the texts that denote one instant agree on it;
    null keys are dropped. Parsing runs where the rows are read, so that only two numbers a row are shuffled.
    """
    parsed = rows.select(canonical_id(F.col(f"`{key}`")).alias(key), instant_us(spark, F.col(f"`{date}`")).alias("us")).filter(F.col(key).isNotNull() & F.col("us").isNotNull())
    return parsed.groupBy(key).agg(F.min("us").alias("utc_us"), F.max("us").alias("last")).filter("utc_us = last").select(key, "utc_us")


def p4_found(spark: SparkSession, at: str) -> DataFrame:
    return message_instants(spark, table(spark, at, "message_summary"))


def p5_found(spark: SparkSession, at: str) -> DataFrame:
    return deliveries.surplus(table(spark, at, "message_summary"))


def p5_kept(spark: SparkSession, at: str) -> DataFrame:
    return deliveries.keep_one(table(spark, at, "message_summary"), fill=("thread_id",)).select("msg_id", F.nullif("thread_id", F.lit("")).alias("thread_id"), "delivery_id")


QUERIES = {"p4_found": p4_found, "p5_found": p5_found, "p5_kept": p5_kept}

_KEYED = r"(SELECT *, lower(regexp_replace(msg_id, '\s+', '', 'g')) AS k FROM message_summary)"
ORACLE = {
    "p5_found": f"SELECT k AS msg_id, delivery_id FROM {_KEYED} QUALIFY row_number() OVER (PARTITION BY k ORDER BY delivery_id) > 1",
    "p5_kept": f"""SELECT k AS msg_id, coalesce(nullif(arg_min(thread_id, delivery_id) FILTER (WHERE trim(thread_id) <> ''), ''), NULL) AS thread_id, min(delivery_id) AS delivery_id
        FROM {_KEYED} GROUP BY k""",
}
