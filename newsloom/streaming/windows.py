"""Event-time windows, bounded deduplication and idempotent appends as streams that drain what is there and stop."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from newsloom.plans.durable import checkpoint_dir
from newsloom.sources.sinks import append_new


def stream(spark: SparkSession, path: str, schema=None) -> DataFrame:
    """A stream over a folder of Parquet files, or one file of it; its naive times become instants, as watermarks need them."""
    schema = schema or spark.read.parquet(path).schema
    files = spark.readStream.schema(schema).parquet(f"{path[:-1]}[{path[-1]}]")  # a pattern may name a file, a plain path only a folder
    return files.select(*(F.col(f.name).cast("timestamp").alias(f.name) if f.dataType.typeName() == "timestamp_ntz" else F.col(f.name) for f in schema))


def drained(result: DataFrame, mode: str = "append") -> DataFrame:
    """The whole result of a stream: run over all available input into the shared folder, then read back."""
    spark = result.sparkSession
    base = f"{checkpoint_dir(spark).rstrip('/')}/newsloom/stream-{uuid.uuid4().hex}"
    out, state = f"{base}/out", f"{base}/state"

    def write(batch: DataFrame, n: int) -> None:
        # a batch that is run again replaces what it wrote before; complete mode keeps the last batch only
        batch.write.mode("overwrite").parquet(f"{out}/batch={n if mode == 'append' else 0}")

    result.writeStream.outputMode(mode).option("checkpointLocation", state).trigger(availableNow=True).foreachBatch(write).start().awaitTermination()
    return spark.read.schema(result.schema).parquet(out).select(*result.columns)


def tumbling(events: DataFrame, ts: str, by: str, size: str, late: str = "1 hour", slide: str | None = None) -> DataFrame:
    """Counts by window and key; with a slide the windows overlap."""
    w = F.window(ts, size, slide) if slide else F.window(ts, size)
    return events.withWatermark(ts, late).groupBy(w.alias("w"), by).agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total")).select(F.col("w.start").alias("start"), F.col("w.end").alias("end"), by, "n", "total")


def sessions(events: DataFrame, ts: str, by: str, gap: str, late: str = "1 hour") -> DataFrame:
    """Sessions of a key: events no further apart than the gap."""
    return events.withWatermark(ts, late).groupBy(F.session_window(ts, gap).alias("w"), by).agg(F.count(F.lit(1)).alias("n")).select(F.col("w.start").alias("start"), F.col("w.end").alias("end"), by, "n")


def deduplicated(events: DataFrame, ts: str, keys: list[str], late: str) -> DataFrame:
    """The first event of each key within the watermark; what comes later than that is for the table's own keys to refuse."""
    return events.withWatermark(ts, late).dropDuplicatesWithinWatermark(keys)


def append_stream(events: DataFrame, path: str, key: str, state: str) -> None:
    """Each key once in the table for good, whatever is delivered again: an anti-join append in every batch."""
    events.writeStream.option("checkpointLocation", state).trigger(availableNow=True).foreachBatch(lambda batch, _: append_new(batch, path, key)).start().awaitTermination()


def silences(last_seen: DataFrame, now: Column, limit_days: int, ts: str = "last_ts") -> DataFrame:
    """Keys that have been silent for longer than the limit at `now`."""
    return last_seen.filter(F.datediff(now, F.col(ts)) > limit_days)


def silence_stream(events: DataFrame, ts: str, by: str, limit: str, late: str = "1 hour") -> DataFrame:
    """(key, last_ts, events): an alert for a key each time it has been silent for longer than the limit, by event time.

    It is the end of a session whose gap is the limit: the watermark closes it once the silence is certain, and the state of the
    key is dropped then."""
    found = events.withWatermark(ts, late).groupBy(F.session_window(ts, limit).alias("w"), by).agg(F.count(F.lit(1)).alias("events"), F.max(ts).alias("last_ts"))
    return found.select(by, "last_ts", "events")
