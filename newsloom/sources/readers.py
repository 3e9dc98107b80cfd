"""Readers of mail folders, rule files, tables as text, event lines and subtitles."""

from __future__ import annotations

import os
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import window as W
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, InputPartition

from newsloom.functions.dates import cue_seconds
from newsloom.functions.text import strip_tags

RULES = "rule_id string, field string, value string, label string"
TRACKER = (
    "segment string, newsletter_name string, publisher string, signup_url string, subscriber_estimate bigint, send_frequency string, double_optin string, description string, pick_type string, subscribe_email string, "
    "gmail_label string, status string, signup_note string, date_subscribed date, expected_next_check date"
)


def eml_folder(spark: SparkSession, path: str) -> DataFrame:
    """(msg_id, raw, length) of every .eml file below a folder, byte for byte; files without a byte hold no message."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.eml").option("recursiveFileLookup", "true").load(path)
    return files.select(F.regexp_extract("path", r"([^/]+)\.eml$", 1).alias("msg_id"), F.col("content").alias("raw"), "length")


class _Page(InputPartition):
    def __init__(self, names: list[str]) -> None:
        self.names = names


class _MailboxReader(DataSourceReader):
    def __init__(self, folder: str, page: int, stop: int, headers: bool) -> None:
        self.folder, self.page, self.stop, self.headers, self.only = folder, page, stop, headers, None

    def pushFilters(self, filters: list) -> Iterator:  # noqa: N802
        for f in filters:
            if isinstance(f, EqualTo) and tuple(f.attribute) == ("msg_id",):
                self.only = f.value
            else:
                yield f

    def partitions(self) -> list[_Page]:
        if self.only is not None:
            names = [f"{self.only}.eml"] if os.path.basename(str(self.only)) == self.only else []  # an id is no path
        else:
            names = sorted(e.name for e in os.scandir(self.folder) if e.name.endswith(".eml"))
        if self.stop:  # asked after each page, so the last page comes whole
            names = names[: -(-self.stop // self.page) * self.page]
        return [_Page(names[i : i + self.page]) for i in range(0, len(names), self.page)] or [_Page([])]

    def read(self, partition: _Page) -> Iterator[tuple]:
        for name in partition.names:
            path = os.path.join(self.folder, name)
            if os.path.exists(path):  # a message that has gone is skipped
                with open(path, "rb") as f:
                    if not self.headers:
                        yield name.removesuffix(".eml"), f.read()
                        continue
                    lines = []
                    for line in f:  # no further than the first blank line
                        if not line.strip(b"\r\n"):
                            break
                        lines.append(line)
                    yield name.removesuffix(".eml"), b"".join(lines)


class MailboxSource(DataSource):
    """A paged mailbox over a folder that every executor mounts: one partition a page; a look-up by msg_id opens only that message.

    Options: path, pagesize (200), stop (no more pages once so many ids are listed; 0 for all) and headersonly. Folders of an
    object store or of HDFS are read by `eml_folder`."""

    @classmethod
    def name(cls) -> str:
        return "mailbox"

    def schema(self) -> str:
        return "msg_id string, raw binary"

    def reader(self, schema: T.StructType) -> DataSourceReader:
        return _MailboxReader(self.options["path"], int(self.options.get("pagesize", "200")), int(self.options.get("stop", "0")), self.options.get("headersonly", "false") == "true")


def mailbox(spark: SparkSession, path: str, page: int = 200, stop: int = 0, headers_only: bool = False) -> DataFrame:
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(MailboxSource)
    return spark.read.format("mailbox").option("path", path).option("pagesize", str(page)).option("stop", str(stop)).option("headersonly", str(headers_only).lower()).load()


def mail_ids(spark: SparkSession, path: str) -> DataFrame:
    """(msg_id, length, modified) of every .eml file with a byte below a folder: the list alone, no file is opened."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.eml").option("recursiveFileLookup", "true").load(path)
    return files.select(F.regexp_extract("path", r"([^/]+)\.eml$", 1).alias("msg_id"), "length", F.col("modificationTime").alias("modified"))


def filter_rules(spark: SparkSession, path: str) -> DataFrame:
    """Rules of a mail filter export: an entry's properties name the tested field, its value and the label."""
    entries = spark.read.format("xml").option("rowTag", "entry").schema("id string, `apps:property` array<struct<_name string, _value string>>").load(path)
    of = lambda name: F.try_element_at(F.transform(F.filter("`apps:property`", lambda p: p["_name"] == name), lambda p: p["_value"]), F.lit(1))
    tested = F.coalesce(*(F.when(of(n).isNotNull(), F.lit(n)) for n in ("from", "hasTheWord")))
    return entries.select(F.coalesce("id", F.md5(F.to_json("`apps:property`"))).alias("rule_id"), tested.alias("field"), F.coalesce(of("from"), of("hasTheWord")).alias("value"), of("label").alias("label"))


def csv_table(spark: SparkSession, path: str, schema: str = TRACKER) -> DataFrame:
    """CSV with a header, quoted line breaks and doubled quotes; fields that don't parse are null."""
    return spark.read.schema(schema).csv(path, header=True, multiLine=True, escape='"', mode="PERMISSIVE")


def json_lines(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """JSON lines without the blank and malformed ones."""
    kind = T._parse_datatype_string(schema)
    parsed = spark.read.text(path).filter(F.trim("value") != "").select(F.from_json("value", kind.add("_bad", "string"), {"columnNameOfCorruptRecord": "_bad"}).alias("r"))
    return parsed.filter(F.col("r").isNotNull() & F.col("r._bad").isNull()).select(*(f"r.`{n}`" for n in kind.names if n != "_bad"))


def cues(lines: DataFrame) -> DataFrame:
    """(video_id, cue_no, start, text) from subtitle lines (video_id, line_no, line).

    The start of a cue is carried to its lines; of each cue only the first text line counts, without tags; a cue equal to
    the one kept before it is dropped. Header, cue numbers and blank lines are no text.
    """
    by = W.Window.partitionBy("video_id").orderBy("line_no")
    stamp = F.regexp_extract("line", r"^\s*(\d{2}:\d{2}:\d{2}[.,]\d{3}) *-->", 1)
    marked = lines.withColumn("start", F.when(stamp != "", cue_seconds(stamp))).withColumn("cue", F.sum(F.col("start").isNotNull().cast("int")).over(by))
    text = F.trim(strip_tags(F.col("line")))
    worded = marked.withColumn("start", F.last("start", ignorenulls=True).over(by.rowsBetween(W.Window.unboundedPreceding, 0))).withColumn("text", text)
    worded = worded.filter((F.col("cue") > 0) & (stamp == "") & (text != "") & ~F.col("line").rlike(r"^\s*\d+\s*$"))
    first = worded.withColumn("r", F.row_number().over(W.Window.partitionBy("video_id", "cue").orderBy("line_no"))).filter("r = 1")
    order = W.Window.partitionBy("video_id").orderBy("cue")
    kept = first.withColumn("was", F.lag("text").over(order)).filter(~F.col("text").eqNullSafe(F.col("was")))
    return kept.select("video_id", F.row_number().over(order).cast("long").alias("cue_no"), "start", "text")
