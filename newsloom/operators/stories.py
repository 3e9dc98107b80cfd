"""Checks of stories before they go out, conflicts with their values, retries, reruns, and the seams for models."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import window as W

#: Facts verified at least; attempts at most.
LEAST_VERIFIED, MOST_ATTEMPTS = 0.95, 3
#: Words of an evidence at most.
EVIDENCE_WORDS = 25


def conflicts_by_unit(facts: DataFrame, by: tuple[str, ...], source: str, value: str) -> DataFrame:
    """(by..., sources, values_by_source) where the sources of one story give an entity different values in one unit.

    A source speaks once, by its smallest value, so the map has one value a source. The values are compared by their extremes;
    no pairs are formed."""
    once = facts.filter(F.col(value).isNotNull() & F.col(source).isNotNull()).groupBy(*by, source).agg(F.min(value).alias("_v"))
    found = once.groupBy(*by).agg(F.count(F.lit(1)).alias("sources"), F.min("_v").alias("_low"), F.max("_v").alias("_high"), F.sort_array(F.collect_list(F.struct(source, "_v"))).alias("_all"))
    return found.filter("_high > _low").select(*by, "sources", F.map_from_entries("_all").alias("values_by_source"))


def repaired(facts: DataFrame, evidence: str, text: str) -> DataFrame:
    """facts with state: `verified` (verbatim), `repaired` (verbatim up to blanks, quotes and case, one pass) or `dropped`; evidence
    that is null, empty or longer than EVIDENCE_WORDS words is dropped."""
    plain = lambda c: F.lower(F.trim(F.regexp_replace(F.translate(c, "“”„‘’«»", "\"\"\"''\"\""), r"\s+", " ")))
    words = F.size(F.filter(F.split(F.col(evidence), r"\s+"), lambda w: w != ""))
    sound = F.coalesce((F.trim(evidence) != "") & (words <= EVIDENCE_WORDS), F.lit(False))
    within = lambda a, b: F.coalesce(F.contains(a, b), F.lit(False))
    return facts.withColumn("state", F.when(~sound, "dropped").when(within(F.col(text), F.col(evidence)), "verified").when(within(plain(F.col(text)), plain(F.col(evidence))), "repaired").otherwise("dropped"))


def story_errors(stories: DataFrame, key: str) -> DataFrame:
    """(key, error) for each broken rule: no source, no fact, a fact from an advertisement, badges that contradict what is known.

    stories has sources, facts, sponsored_facts, conflicts, vendor_claims (numbers; null counts as 0) and badges (an array; null
    is empty)."""
    n = lambda c: F.coalesce(c, F.lit(0))
    has = lambda b: F.coalesce(F.array_contains("badges", b), F.lit(False))
    rules = {
        "no source": n("sources") < 1, "no fact": n("facts") < 1, "sponsored fact": n("sponsored_facts") > 0, "conflict without sources_differ": (n("conflicts") > 0) & ~has("sources_differ"),
        "vendor claim without self_reported": (n("vendor_claims") > 0) & ~has("self_reported"), "single source without reported": (n("sources") == 1) & ~has("reported"), "sources_differ without conflict": has("sources_differ") & (n("conflicts") == 0),
    }
    return stories.select(key, F.explode(F.filter(F.array(*(F.when(c, name) for name, c in rules.items())), lambda x: x.isNotNull())).alias("error"))


def badges(coverage: str = "sources", conflicts: str = "conflicts", vendor: str = "vendor_claims"):
    """The badges that follow from what is known of a story, sorted."""
    n = lambda c: F.coalesce(c, F.lit(0))
    given = F.array(F.when(n(coverage) == 1, "reported"), F.when(n(vendor) > 0, "self_reported"), F.when(n(conflicts) > 0, "sources_differ"))
    return F.filter(given, lambda x: x.isNotNull())


def differences(first: DataFrame, second: DataFrame) -> DataFrame:
    """(side, rows): rows that only one of two runs has, repeated rows counted; two rows, both 0 if a rerun changes nothing."""
    side = lambda a, b, name: a.exceptAll(b).agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("side"), "rows")
    second = second.select(*first.columns)
    return side(first, second, "first only").unionByName(side(second, first, "second only"))


def archive_errors(stored: DataFrame, again: DataFrame, key: str, content: str) -> DataFrame:
    """(key, error): what a regenerated archive lacks, has beside, or has otherwise than the stored one."""
    hashed = lambda d, n: d.select(key, F.sha2(F.coalesce(F.col(content), F.lit("")), 256).alias(n))
    both = hashed(stored, "_a").join(hashed(again, "_b"), key, "full_outer")
    return both.select(key, F.when(F.col("_b").isNull(), "missing").when(F.col("_a").isNull(), "new").when(F.col("_a") != F.col("_b"), "changed").alias("error")).filter("error IS NOT NULL")


def retry_queue(attempts: DataFrame, key: str, at: str, status: str, most: int = MOST_ATTEMPTS) -> DataFrame:
    """(key, attempts, state): `done` if the last attempt ended well, `retry` while attempts are left, else `given up`. Ties in time go
    by status. An aggregate: a key of many attempts is one row a task."""
    last = attempts.groupBy(key).agg(F.count(F.lit(1)).alias("attempts"), F.max_by(status, F.struct(at, status)).alias("_last"))
    return last.select(key, "attempts", F.when(F.col("_last").isin("ok", "done"), "done").when(F.col("attempts") < most, "retry").otherwise("given up").alias("state"))


def prior_days(mentions: DataFrame, entity: str, day: str) -> DataFrame:
    """(entity, day, n, prior_day, prior_n): each day on which an entity is mentioned with the day before it on which it was and the
    mentions up to then. Days are counted first, so a frequent entity is a row a day."""
    per = mentions.filter(F.col(entity).isNotNull() & F.col(day).isNotNull()).groupBy(entity, day).agg(F.count(F.lit(1)).alias("n"))
    order = W.Window.partitionBy(entity).orderBy(day)
    return per.select(entity, day, "n", F.lag(day).over(order).alias("prior_day"), F.coalesce(F.sum("n").over(order.rowsBetween(W.Window.unboundedPreceding, -1)), F.lit(0)).alias("prior_n"))


def repeated_sends(sent: DataFrame, *key: str) -> DataFrame:
    """(key..., sends): keys that were sent more than once."""
    return sent.groupBy(*key).agg(F.count(F.lit(1)).alias("sends")).filter("sends > 1")


# ---- seams


def extracted(sections: DataFrame, extractors: Mapping[str, Callable[[DataFrame], DataFrame]]) -> DataFrame:
    """The cards of all extractors, each with the name of its `extractor`; columns that one lacks are null. An extractor is a
    function from sections to cards, of built-in expressions or of a model."""
    out = None
    for name, f in extractors.items():
        part = f(sections).withColumn("extractor", F.lit(name))
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    if out is None:
        raise ValueError("no extractor")
    return out


def judged(pairs: DataFrame, judge: Callable[[DataFrame], DataFrame] | None = None, similarity: str = "similarity", common: str = "common") -> DataFrame:
    """pairs with verdict and reason: by the judge that is handed in, else by rule: `same` if headlines are near (0.8) or near enough
    (0.6) with two entities in common, else `different`."""
    if judge is not None:
        return judge(pairs)
    near, shared = F.col(similarity) >= 0.8, (F.col(similarity) >= 0.6) & (F.coalesce(common, F.lit(0)) >= 2)
    return pairs.withColumn("verdict", F.when(near | shared, "same").otherwise("different")).withColumn("reason", F.when(near, "headlines").when(shared, "entities").otherwise("neither"))
