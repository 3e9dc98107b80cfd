"""Checks of facts and texts: evidence, conflicts, numbers, quotes, badges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsloom.functions.text import number_unit, number_value, numbers, word_count


def verified(facts: DataFrame, texts: DataFrame, key: str, evidence: str, text: str) -> DataFrame:
    """facts with verified: whether the evidence is an exact part of its text. Missing texts and empty evidence verify nothing."""
    joined = facts.join(texts.select(key, F.col(text).alias("_nl_text")), key, "left")
    return joined.withColumn("verified", F.coalesce((F.length(evidence) > 0) & F.contains("_nl_text", F.col(evidence)), F.lit(False))).drop("_nl_text")


def conflicts(facts: DataFrame, entity: str, source: str, value: str, tolerance: float = 0.0) -> DataFrame:
    """Entities whose sources state values further apart than the tolerance allows: (entity, sources, lowest, highest, spread).

    A source speaks once, by its lowest value; the comparison is of extremes, so no pairs are formed."""
    once = facts.filter(F.col(value).isNotNull()).groupBy(entity, source).agg(F.min(value).alias("v"))
    wide = once.groupBy(entity).agg(F.count(F.lit(1)).alias("sources"), F.min("v").alias("lowest"), F.max("v").alias("highest"))
    spread = F.try_divide(F.col("highest") - F.col("lowest"), F.abs("lowest"))
    return wide.withColumn("spread", spread).filter((F.col("sources") > 1) & (F.col("highest") > F.col("lowest")) & (F.col("spread") > tolerance))


def splits(claims: DataFrame, story: str, stance: str, least: int = 2, most: int = 3) -> DataFrame:
    """Stories on which at least `least` claims take at least `least` sides: (story, claims, sides), the first `most` sides."""
    grouped = claims.filter(F.col(stance).isNotNull()).groupBy(story).agg(F.count(F.lit(1)).alias("claims"), F.array_sort(F.collect_set(stance)).alias("all"))
    return grouped.filter((F.col("claims") >= least) & (F.size("all") >= least)).select(story, "claims", F.slice("all", 1, most).alias("sides"))


def unknown_numbers(copy: DataFrame, facts: DataFrame, key: str, text: str) -> DataFrame:
    """(key, number): numbers in the copy of a story that no fact of it has, by value and unit."""
    used = copy.select(key, F.explode(numbers(F.col(text))).alias("number")).select(key, "number", number_value(F.col("number")).alias("v"), number_unit(F.col("number")).alias("unit"))
    known = facts.select(key, number_value(F.col("value")).alias("v"), number_unit(F.col("value")).alias("unit"))
    return used.join(known, [key, "v", "unit"], "left_anti").select(key, "number")


def bad_quotes(quotes: DataFrame, texts: DataFrame, key: str, longest: int = 15) -> DataFrame:
    """(key, quote, reason): quotes that are too long, not verbatim, or more than one for a story."""
    n = quotes.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    joined = quotes.join(texts.select(key, F.col("text").alias("_t")), key, "left").join(n, key)
    reason = F.when(word_count(F.col("quote")) >= longest, "long").when(~F.coalesce(F.contains("_t", F.col("quote")), F.lit(False)), "not verbatim").when(F.col("_n") > 1, "several")
    return joined.withColumn("reason", reason).filter("reason IS NOT NULL").select(key, "quote", "reason")
