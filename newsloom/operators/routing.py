"""Messages routed to segments, labelled by rules and classified by their subjects."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsloom.functions.text import plus_tag
from newsloom.plans.durable import durable, join_counted

#: Sender rules in a block.
RULE_BLOCK = 2000
# Phrases in subjects of mail that is no issue.
CONFIRM_PHRASES = ("confirm", "verify", "welcome", "complete your sign", "one-time", "added successfully", "now signed up", "now subscribed", "thanks for signing", "a few things", "verification code", "on the list")
CONFIRM = f"(?i)({'|'.join(CONFIRM_PHRASES)})"
# Words of pages behind a test for robots, and of texts behind a paywall.
ROBOT_TEST = ("captcha", "recaptcha", "hcaptcha", "cf-turnstile", "cloudflare", "bot check", "verify you")
PAYWALL = ("paywall", "subscribe to read", "become a member", "paid subscriber", "upgrade to")
# Subjects of checks whether a reader is still there.
ENGAGEMENT = r"(?i)(we are going on a break|still want|still there|we miss you|are you still)"
KINDS = (("engagement_check", ENGAGEMENT), ("verify", r"(?i)(verification code|verify)"), ("confirm", r"(?i)confirm"), ("welcome", r"(?i)(^welcome|thanks? (?:you )?for (?:signing|subscribing))"), ("podcast_notice", r"(?i)^(?:Fwd: )?\[podcast\]"), ("promo", r"(?i)\b\d+% off\b"))


def segment_tags(segments: DataFrame) -> DataFrame:
    """(tag, segment) from the addresses that segments subscribe with."""
    return segments.select(plus_tag(F.col("subscribe_email")).alias("tag"), "segment").filter("tag IS NOT NULL")


def by_tag(messages: DataFrame, segments: DataFrame, to: Column, fallback: Column | None = None) -> DataFrame:
    """messages with segment: by the tag of the address they were sent to, else by the fallback, else `unmatched`."""
    tags = segment_tags(segments).groupBy("tag").agg(F.min("segment").alias("_seg"))
    routed = messages.withColumn("tag", plus_tag(to)).join(tags, "tag", "left")
    return routed.withColumn("segment", F.coalesce("_seg", fallback if fallback is not None else F.lit(None).cast("string"), F.lit("unmatched"))).drop("_seg", "tag")


def labels_by_rules(messages: DataFrame, rules: DataFrame, key: str, sender: str, to: str) -> DataFrame:
    """(key, labels): the set of labels of all rules that match. Address rules are an equality; sender rules test whether the
    sender holds the value. They go over the distinct senders, not over the messages, in blocks of RULE_BLOCK, each of which is
    broadcast; the labels then reach the messages by a join in which senders of many messages are split."""
    exact = rules.filter("field = 'to'").select(F.lower("value").alias("_v"), "label")
    hits = messages.select(key, F.lower(F.col(to)).alias("_v")).join(exact, "_v").select(key, "label")
    holds = rules.filter("field <> 'to' AND value <> ''").select(F.lower("value").alias("_v"), "label")
    slim = messages.select(key, F.lower(F.col(sender)).alias("_s")).filter("_s IS NOT NULL")
    senders = durable(slim.groupBy("_s").agg(F.count(F.lit(1)).alias("_n")))
    blocks = -(-holds.count() // RULE_BLOCK)
    found = None
    for i in range(blocks):
        block = holds.filter(F.pmod(F.xxhash64("_v", "label"), F.lit(blocks)) == i)
        part = senders.join(F.broadcast(block), F.contains("_s", F.col("_v"))).select("_s", "_n", "label")
        found = part if found is None else found.unionByName(part)
    if found is not None:
        sets = durable(found.groupBy("_s").agg(F.first("_n").alias("_n"), F.collect_set("label").alias("_l")))
        hits = hits.unionByName(join_counted(slim, sets, "_s", "_n", sets.agg(F.sum("_n")).first()[0] or 0).select(key, F.explode("_l").alias("label")))
    return hits.groupBy(key).agg(F.array_sort(F.collect_set("label")).alias("labels"))


def signal(page: Column, words: tuple[str, ...]) -> Column:
    """Whether one of the words stands in the page, in any case; null for null."""
    low = F.lower(page)
    out = F.contains(low, F.lit(words[0]))
    for w in words[1:]:
        out = out | F.contains(low, F.lit(w))
    return out


def paywall_cut(text: Column) -> Column:
    """Where the first paywall phrase begins (from 1); null without one."""
    low = F.lower(text)
    return F.array_min(F.filter(F.array(*(F.locate(w, low) for w in PAYWALL)), lambda x: x > 0))


def kind(subject: Column) -> Column:
    """The kind that the first matching rule gives a decoded subject; `other` for a blank one, `issue` else."""
    out = F.when(F.trim(F.coalesce(subject, F.lit(""))) == "", "other")
    for name, pattern in KINDS:
        out = out.when(subject.rlike(pattern), name)
    return out.otherwise("issue")


def is_issue(subject: Column) -> Column:
    return F.when(F.coalesce(F.trim(subject), F.lit("")) == "", 0).when(subject.rlike(CONFIRM), 0).otherwise(1)


# ---- senders


def without_own(messages: DataFrame, sender: str, own: tuple[str, ...]) -> DataFrame:
    """messages without one's own and the system's mail: those whose sender holds one of the texts, in any case. A null sender
    stays."""
    low = F.lower(F.coalesce(F.col(sender), F.lit("")))
    for text in own:
        messages = messages.filter(~F.contains(low, F.lit(text.lower())))
    return messages


def _by_distinct(messages: DataFrame, sender: str, matched: Callable[[DataFrame], DataFrame], columns: tuple[str, ...]) -> DataFrame:
    """messages with the columns that `matched` finds for each distinct sender, null where it finds none."""
    keyed = messages.withColumn("_s", F.lower(F.coalesce(F.col(sender), F.lit(""))))
    senders = durable(keyed.groupBy("_s").agg(F.count(F.lit(1)).alias("_n")))
    found = durable(senders.join(matched(senders.select("_s")), "_s", "left").select("_s", "_n", *columns))
    return join_counted(keyed, found, "_s", "_n", found.agg(F.sum("_n")).first()[0] or 0).drop("_s", "_n")


def by_sender(messages: DataFrame, rules: DataFrame, sender: str, column: str = "by_sender") -> DataFrame:
    """messages with the segment of the first rule (rank, value, segment) whose value the sender holds; null if there is none."""
    ordered = rules.select("rank", F.lower("value").alias("_v"), F.col("segment").alias("_seg")).filter("_v <> ''")

    def matched(senders: DataFrame) -> DataFrame:
        hits = senders.join(F.broadcast(ordered) if ordered.count() <= RULE_BLOCK else ordered, F.contains("_s", F.col("_v")))
        return hits.groupBy("_s").agg(F.min_by("_seg", F.struct("rank", "_v")).alias(column))

    return _by_distinct(messages, sender, matched, (column,))


def sources_of(messages: DataFrame, roster: DataFrame, sender: str, column: str = "source_id") -> DataFrame:
    """messages with the source of a roster (source_id, sender_match, alias_match): an equal address with its alias first, then an
    equal address, then an address that holds the text; ties go to the longer text, then the smaller id."""
    rules = roster.filter(F.col("sender_match") != "").select(F.col("source_id").alias("_id"), F.lower("sender_match").alias("_m"), F.lower(F.coalesce("alias_match", F.lit(""))).alias("_a"))

    def matched(senders: DataFrame) -> DataFrame:
        inner = F.regexp_extract("_s", r"<([^<>]*)>\s*$", 1)
        full = F.trim(F.when(inner != "", inner).otherwise(F.col("_s")))
        parts = senders.select("_s", full.alias("_full"), F.regexp_replace(full, r"\+[^@]*@", "@").alias("_plain"), F.regexp_extract(full, r"\+([^@]*)@", 1).alias("_alias"))
        equal = parts.join(rules, F.col("_plain") == F.col("_m")).filter((F.col("_a") == "") | (F.col("_a") == F.col("_alias")))
        equal = equal.select("_s", F.when(F.col("_a") != "", 1).otherwise(2).alias("_rank"), "_m", "_id")
        held = parts.join(F.broadcast(rules) if rules.count() <= RULE_BLOCK else rules, F.contains("_full", F.col("_m"))).filter("_a = ''").select("_s", F.lit(3).alias("_rank"), "_m", "_id")
        return equal.unionByName(held).groupBy("_s").agg(F.min_by("_id", F.struct("_rank", -F.length("_m"), "_id")).alias(column))

    return _by_distinct(messages, sender, matched, (column,))


# What an alias of a sender and an emoji before a subject tell of an issue.
ALIAS_KINDS = {"deep": "issue", "deepdives": "issue", "pulse": "issue", "the-pulse": "issue"}
EMOJI_KINDS = {"🔮": "issue", "📈": "issue", "🚨": "issue", "👀": "promo"}


def kind_by_rules(subject: Column, sender: Column) -> Column:
    """(kind, rule_id) in stages: the subject, the sender's alias, the emoji before the subject; both null where no rule speaks
    (an ambiguous message, to be judged), `other` for a blank subject."""
    alias = F.regexp_extract(F.lower(sender), r"\+([^@>\s]*)@", 1)
    out = F.when(F.trim(F.coalesce(subject, F.lit(""))) == "", F.struct(F.lit("other").alias("kind"), F.lit("subject:blank").alias("rule_id")))
    for name, pattern in KINDS:
        out = out.when(subject.rlike(pattern), F.struct(F.lit(name).alias("kind"), F.lit(f"subject:{name}").alias("rule_id")))
    for tag, name in ALIAS_KINDS.items():
        out = out.when(alias == tag, F.struct(F.lit(name).alias("kind"), F.lit(f"alias:{tag}").alias("rule_id")))
    for sign, name in EMOJI_KINDS.items():
        out = out.when(F.startswith(subject, F.lit(sign)), F.struct(F.lit(name).alias("kind"), F.lit(f"emoji:{sign}").alias("rule_id")))
    return out


# ---- sponsors

# Labels and house blocks that mark a section as an advertisement.
SPONSOR_LABELS = ("(sponsor)", "presented by", "from our partners", "a message from", "sponsored by", "in partnership", "advertisement", "ad enquiries")
HOUSE_BLOCKS = ("free resource", "shameless promo", "highly recommended")
OFFERINGS = ("reg a ", "regulation a offering", "securities offering")


def sponsor_reasons(section: Column, partners: tuple[str, ...] = (), referrals: tuple[str, ...] = ()) -> Column:
    """Why a section is an advertisement, sorted; empty if it is none: label, house, offering, partner (a starred name), referral
    (a link to a referral host). The section is kept; nothing is extracted from it."""
    low = F.lower(section)
    any_of = lambda words: reduce(lambda a, b: a | b, (F.contains(low, F.lit(w.lower())) for w in words), F.lit(False))
    tests = {"house": any_of(HOUSE_BLOCKS), "label": any_of(SPONSOR_LABELS), "offering": any_of(OFFERINGS), "partner": any_of(tuple(f"{p}*" for p in partners)), "referral": any_of(tuple(f"//{r}/" for r in referrals))}
    return F.filter(F.array(*(F.when(t, name) for name, t in tests.items())), lambda x: x.isNotNull())
