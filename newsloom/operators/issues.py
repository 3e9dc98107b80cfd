"""Artifacts of issues: what is written for each of them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsloom.functions.html import from_markdown

KINDS = ("json", "txt", "html", "validation.md", "trace.md")


def artifacts(stories: DataFrame, issue: tuple[str, ...], key: str, headline: str, source: str, errors: DataFrame | None = None) -> DataFrame:
    """(issue..., kind, content): one row per issue and artifact, ready to be written as files.

    stories has the columns of the issue, a key, a headline and a source; errors has (key, error). Stories are in the order of
    their keys. An issue is a list of stories, never a whole table, so it is gathered in one row; an issue without errors says so.
    """
    found = stories.select(*issue, key, F.coalesce(headline, F.lit("")).alias("_h"), F.coalesce(source, F.lit("?")).alias("_s"))
    if errors is not None:
        found = found.join(errors.groupBy(key).agg(F.array_sort(F.collect_set("error")).alias("_e")), key, "left")
    else:
        found = found.withColumn("_e", F.lit(None).cast("array<string>"))
    rows = found.groupBy(*issue).agg(F.array_sort(F.collect_list(F.struct(F.col(key).alias("k"), F.col("_h").alias("h"), F.col("_s").alias("s"), F.coalesce("_e", F.array().cast("array<string>")).alias("e")))).alias("_r"))
    lines = lambda f: F.array_join(F.transform("_r", f), "\n")
    id_of = lambda x: x["k"].cast("string")
    title = F.concat_ws(" ", *(F.col(c).cast("string") for c in issue))
    markdown = F.concat(F.lit("# "), title, F.lit("\n"), lines(lambda x: F.concat(F.lit("- "), x["h"])))
    wrong: Column = F.filter(F.transform("_r", lambda x: F.when(F.size(x["e"]) > 0, F.concat(F.lit("- "), id_of(x), F.lit(": "), F.array_join(x["e"], ", ")))), lambda x: x.isNotNull())
    content = {
        "json": F.to_json(F.struct(*issue, F.transform("_r", lambda x: F.struct(x["k"].alias(key), x["h"].alias("headline"), x["s"].alias("source"))).alias("stories"))), "txt": F.concat(title, F.lit("\n"), lines(lambda x: x["h"])), "html": from_markdown(markdown),
        "validation.md": F.when(F.size(wrong) > 0, F.array_join(wrong, "\n")).otherwise("no errors"), "trace.md": lines(lambda x: F.concat(F.lit("- "), id_of(x), F.lit(" < "), x["s"])),
    }
    return rows.select(*issue, F.explode(F.array(*(F.struct(F.lit(n).alias("kind"), c.alias("content")) for n, c in content.items()))).alias("_a")).select(*issue, "_a.*")
