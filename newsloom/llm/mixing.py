"""Records of several sources combined to target shares of the total size, each at most a capped number of times.

The tree has domains below the root, languages below each domain and sources below each language: a leaf is what one source
has in one domain and language. A source's weight is divided among its leaves by their tokens, and a node weighs what its
leaves weigh. Each node divides its budget among its children by weight; a child that can't use its part (its leaves, repeated
as often as allowed, are too small) leaves the rest to its siblings, again by weight, and only what no sibling can use goes
back to the parent's siblings. A source without any record has no leaf, so its share goes to all at the root.

A leaf takes whole epochs of its records and then a prefix, in tokens, of one more epoch in seeded order. The prefix sums are
taken in two steps over hash ranges whose number follows from the leaf's records, so that no task orders a whole leaf. What
the prefixes of a source leave over, less than a record each, takes the next records of its leaves, one a leaf.

Nothing reaches the driver but counts. Defined results: sources without a target are not taken; targets without records or
with a null or non-positive share or cap get nothing and their share goes on; null languages and domains are a branch of their
own; ties in the seeded order go by key; empty tables give empty results.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import window as W

from newsloom.plans.durable import durable, join_counted

#: Seed of the epochs' order; records of a hash range on average.
SEED, RANGE_ROWS = 20240229, 50_000
#: Tables are broadcast up to so many rows.
BROADCAST_ROWS = 200_000
#: A null domain or language in the tree.
NONE = "\u0000"
LEAF = ["source", "domain", "lang"]


def divided(nodes: DataFrame, parent: list[str], total: str = "total") -> DataFrame:
    """nodes (weight, limit, the budget of the parent in `total`) with `budget`: by weight, none above its limit.

    Siblings are ordered by limit per weight. As long as the level that the rest would reach exceeds a sibling's limit, it is
    full; what the full ones leave is divided by weight among the others.
    """
    nodes = nodes.filter(F.col("weight") > 0)
    ranked = W.Window.partitionBy(*parent).orderBy(F.col("limit") / F.col("weight"))
    before = lambda c: F.coalesce(F.sum(c).over(ranked.rowsBetween(W.Window.unboundedPreceding, -1)), F.lit(0.0))
    onwards = F.sum("weight").over(ranked.rowsBetween(0, W.Window.unboundedFollowing))
    full = nodes.withColumn("_full", F.col("limit") * onwards <= (F.col(total) - before("limit")) * F.col("weight"))
    all_of = W.Window.partitionBy(*parent)
    left = F.col(total) - F.sum(F.when(F.col("_full"), F.col("limit")).otherwise(0.0)).over(all_of)
    weights = F.sum(F.when(F.col("_full"), 0.0).otherwise(F.col("weight"))).over(all_of)
    return full.withColumn("budget", F.when(F.col("_full"), F.col("limit")).otherwise(F.greatest(F.lit(0.0), left) * F.try_divide("weight", weights))).drop("_full")


def budgets(leaves: DataFrame, total: Column) -> DataFrame:
    """leaves (source, domain, lang, weight, limit) with `budget` in tokens, by the tree."""
    sums = [F.sum("weight").alias("weight"), F.sum("limit").alias("limit")]
    sound = leaves.filter(F.col("weight") > 0)  # a leaf that may not be used still leaves its share to its siblings
    domains = divided(sound.groupBy("domain").agg(*sums).withColumn("_root", F.lit(0)).withColumn("total", total), ["_root"])
    langs = sound.groupBy("domain", "lang").agg(*sums).join(domains.select("domain", F.col("budget").alias("total")), "domain")
    sources = sound.join(divided(langs, ["domain"]).select("domain", "lang", F.col("budget").alias("total")), ["domain", "lang"])
    given = divided(sources, ["domain", "lang"]).select(*LEAF, "budget")
    return leaves.join(given, LEAF, "left").withColumn("budget", F.coalesce("budget", F.lit(0.0)))


def planned(sized: DataFrame, targets: DataFrame, total: int | None = None) -> DataFrame:
    """One row per leaf: weight, cap, records, tokens, budget, whole epochs and the rest of one more; written once.

    sized has doc_id, source, lang, segment (the domain), tokens. Without a total, the tokens of one epoch of all target
    sources are it.
    """
    wanted = _wanted(targets)
    cells = sized.filter(F.col("tokens") > 0).groupBy("source", F.coalesce("segment", F.lit(NONE)).alias("domain"), F.coalesce("lang", F.lit(NONE)).alias("lang")).agg(F.sum("tokens").cast("long").alias("tokens"), F.count(F.lit(1)).alias("rows"))
    cells = durable(cells.join(wanted, "source"))
    whole = F.lit(float(total)) if total is not None else F.coalesce(cells.agg(F.sum("tokens")).scalar(), F.lit(0)).cast("double")
    of_source = cells.groupBy("source").agg(F.sum("tokens").alias("of_source"))
    leaves = cells.join(of_source, "source").withColumn("weight", F.col("share") * F.col("tokens") / F.col("of_source")).withColumn("limit", (F.col("tokens") * F.col("cap")).cast("double")).drop("of_source")
    budget = F.least("limit", F.floor(F.col("budget") + 1e-6).cast("double")).cast("long")
    out = budgets(leaves, whole).withColumn("budget", budget)
    return durable(out.withColumn("epochs", F.expr("budget DIV tokens")).withColumn("rest", F.expr("budget % tokens")).withColumn("ranges", F.ceil(F.col("rows") / RANGE_ROWS).cast("long")))


def _wanted(targets: DataFrame) -> DataFrame:
    """(source, share, cap): one row a target, never negative."""
    positive = lambda c: F.greatest(F.lit(0), F.coalesce(F.max(c), F.lit(0)))
    return targets.filter(F.col("source").isNotNull()).groupBy("source").agg(positive("target_share").cast("double").alias("share"), positive("max_repeats").cast("long").alias("cap"))


def mix(sized: DataFrame, targets: DataFrame, total: int | None = None, seed: int = SEED) -> tuple[DataFrame, DataFrame]:
    """(doc_id, source, tokens, times) of the records taken, and the leaves with their budgets."""
    leaves = planned(sized, targets, total)
    count, rows = leaves.agg(F.count(F.lit(1)), F.coalesce(F.sum("rows"), F.lit(0))).first()
    slim = leaves.select(F.struct(*LEAF).alias("leaf"), "rows", "cap", "budget", "epochs", "rest", "ranges")
    own = sized.filter(F.col("tokens") > 0).select("doc_id", "tokens", F.struct("source", F.coalesce("segment", F.lit(NONE)).alias("domain"), F.coalesce("lang", F.lit(NONE)).alias("lang")).alias("leaf"))
    own = own.join(F.broadcast(slim), "leaf") if count <= BROADCAST_ROWS else join_counted(own, slim, "leaf", "rows", rows)
    own = own.withColumn("at", F.xxhash64("doc_id", F.lit(seed) + F.col("epochs")))
    own = own.withColumn("range", F.shiftright(F.shiftrightunsigned("at", 33) * F.col("ranges"), 31))  # hashes in order, cut evenly
    order = [F.shiftrightunsigned("at", 1), "doc_id"]
    per = own.groupBy("leaf", "range").agg(F.sum("tokens").alias("n"))
    before = W.Window.partitionBy("leaf").orderBy("range").rowsBetween(W.Window.unboundedPreceding, -1)
    starts = per.select("leaf", "range", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    inside = W.Window.partitionBy("leaf", "range").orderBy(*order).rowsBetween(W.Window.unboundedPreceding, W.Window.currentRow)
    summed = own.join(starts, ["leaf", "range"]).withColumn("upto", F.col("start") + F.sum("tokens").over(inside))
    summed = durable(summed.select("leaf", "doc_id", "tokens", "cap", "budget", "epochs", "upto", (F.col("epochs") + (F.col("upto") <= F.col("rest")).cast("long")).alias("times")))
    # what the prefixes of a source leave over takes the next record of each leaf, in seeded order, as far as it goes
    used = summed.groupBy("leaf").agg(F.first("budget").alias("budget"), F.sum(F.col("tokens") * F.col("times")).alias("used"), F.min_by(F.struct("doc_id", "upto", "tokens"), F.when((F.col("times") == F.col("epochs")) & (F.col("epochs") < F.col("cap")), F.col("upto"))).alias("next"))
    of_source = W.Window.partitionBy("leaf.source")
    running = of_source.orderBy(F.xxhash64("leaf", F.lit(seed)), "leaf").rowsBetween(W.Window.unboundedPreceding, W.Window.currentRow)
    more = used.withColumn("free", F.sum(F.col("budget") - F.col("used")).over(of_source)).withColumn("took", F.sum("next.tokens").over(running))
    more = durable(more.filter("next IS NOT NULL AND took <= free").select("leaf", "next.doc_id", "next.upto", F.lit(1).alias("extra")))
    topped = summed.join(F.broadcast(more) if more.count() <= BROADCAST_ROWS else more, ["leaf", "doc_id", "upto"], "left")
    taken = topped.select("doc_id", "leaf.source", "tokens", (F.col("times") + F.coalesce("extra", F.lit(0))).cast("int").alias("times")).filter("times > 0")
    return taken, leaves


def report(taken: DataFrame, leaves: DataFrame, targets: DataFrame) -> DataFrame:
    """Per target: its share as wanted and as it really is, with what it was given and took."""
    took = taken.groupBy("source").agg(F.sum(F.col("tokens") * F.col("times")).alias("taken_tokens"), F.max("times").alias("most_times"))
    has = leaves.groupBy("source").agg(F.count(F.lit(1)).alias("leaves"), F.sum("tokens").alias("source_tokens"), F.sum("budget").alias("budget_tokens"))
    both = _wanted(targets).join(has, "source", "left").join(took, "source", "left")
    whole = took.agg(F.sum("taken_tokens")).scalar()
    zero = lambda c: F.coalesce(c, F.lit(0)).alias(c)
    return both.select("source", F.col("share").alias("target_share"), F.col("cap").cast("int").alias("max_repeats"), zero("leaves"), zero("source_tokens"), zero("budget_tokens"), zero("taken_tokens"), zero("most_times"),
        F.round(F.try_divide(F.coalesce("taken_tokens", F.lit(0)), whole), 6).alias("actual_share"))
