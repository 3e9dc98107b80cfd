"""Incremental intake: what the roster's senders delivered since the last good run, and is not in the store."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def watermark(runs: DataFrame, at: str = "run_at", status: str = "status") -> Column:
    """The time of the last run that ended well, as a scalar; null before the first."""
    return runs.filter(F.col(status) == "ok").agg(F.max(at)).scalar()


def incremental(messages: DataFrame, roster: DataFrame, stored: DataFrame, key: str, sender: str, ts: str, since: Column, overlap_days: int = 2) -> DataFrame:
    """New messages, each once, the earliest delivery of each.

    The window reaches back over `overlap_days` before the watermark, so that mail that arrived late is not missed; the store
    alone decides what is new, so that a second run adds nothing. Null keys are left out.
    """
    due = messages.filter(F.col(key).isNotNull() & (since.isNull() | (F.col(ts) > since - F.make_interval(days=F.lit(overlap_days)))))
    wanted = due.join(roster.select(sender).distinct(), sender, "left_semi").join(stored.select(key), key, "left_anti")
    return wanted.groupBy(key).agg(F.min_by(F.struct(sender, ts), ts).alias("_r")).select(key, "_r.*")
