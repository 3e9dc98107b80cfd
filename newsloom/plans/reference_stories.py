"""Queries of the story pipeline: routing by sender, kinds, sponsors, conflicts, checks, retries, seams."""

from __future__ import annotations

from pyspark.sql import functions as F

from newsloom.functions import jsons, search, text, urls
from newsloom.operators import deliveries, issues, routing, selection, stories
from newsloom.plans import fixtures as X
from newsloom.plans import reference_corpus as corpus
from newsloom.plans import reference_mail as mail
from newsloom.plans.durable import durable
from newsloom.sources import mime
from newsloom.sources.tables import canonical_id, table

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLE[f.__name__] = sql
        return f

    return add


# ---- mail

OWN_MAIL = ("readerbox@inbox.example", "no-reply.")


@query(rf"""WITH own AS (SELECT * FROM {mail.FIRST} WHERE NOT ({' OR '.join(f"contains(lower(coalesce(from_h, '')), '{w}')" for w in OWN_MAIL)})),
    s AS (SELECT regexp_extract(lower(subscribe_email), '\+([a-z]+)@', 1) AS tag, min(segment) AS segment FROM segments GROUP BY 1),
    b AS (SELECT k, arg_min(r.segment, r.rank) AS seg FROM own JOIN {X.SENDER_ROUTES.sql()} r ON r.value <> '' AND contains(lower(coalesce(from_h, '')), lower(r.value)) GROUP BY k),
    t AS (SELECT own.k, s.segment AS tagged, b.seg FROM own LEFT JOIN s ON s.tag = nullif(regexp_extract(lower(coalesce(nullif(trim(delivered_to), ''), nullif(trim(to_h), ''))), '\+([a-z]+)@', 1), '') LEFT JOIN b USING (k))
    SELECT coalesce(tagged, seg, 'unmatched') AS segment, CASE WHEN tagged IS NOT NULL THEN 'tag' WHEN seg IS NOT NULL THEN 'sender' ELSE 'none' END AS routed_by, count(*) AS messages FROM t GROUP BY ALL""")  # fmt: skip
def route_messages(spark, at):
    """By the tag of the address, else by the first sender rule; own and system mail is left out."""
    m = routing.without_own(mail.messages(spark, at, "from_h", "to_h", "delivered_to"), "from_h", OWN_MAIL)
    ruled = routing.by_sender(m, X.SENDER_ROUTES.spark(spark), "from_h")
    tagged = routing.by_tag(ruled, table(spark, at, "segments"), text.first_filled(F.col("delivered_to"), F.col("to_h")), F.col("by_sender"))
    plain = routing.by_tag(tagged.withColumnRenamed("segment", "routed"), table(spark, at, "segments"), text.first_filled(F.col("delivered_to"), F.col("to_h")))
    by = F.when(F.col("segment") != "unmatched", "tag").when(F.col("by_sender").isNotNull(), "sender").otherwise("none")
    return plain.groupBy(F.col("routed").alias("segment"), by.alias("routed_by")).agg(F.count(F.lit(1)).alias("messages"))


_RULED = " ".join(
    [f"WHEN regexp_matches(s, '{p.replace(chr(39), chr(39) * 2)}') THEN '{n}|subject:{n}'" for n, p in routing.KINDS] + [f"WHEN alias = '{a}' THEN '{k}|alias:{a}'" for a, k in routing.ALIAS_KINDS.items()] + [f"WHEN starts_with(s, '{e}') THEN '{k}|emoji:{e}'" for e, k in routing.EMOJI_KINDS.items()]
)


@query(rf"""SELECT nullif(split_part(r, '|', 1), '') AS kind, nullif(split_part(r, '|', 2), '') AS rule_id, count(*) AS messages FROM (SELECT CASE WHEN coalesce(trim(s), '') = '' THEN 'other|subject:blank' {_RULED} ELSE '' END AS r
    FROM (SELECT {mail._DECODED} AS s, regexp_extract(lower(from_h), '\+([^@>\s]*)@', 1) AS alias FROM {mail.FIRST})) GROUP BY ALL""")  # fmt: skip
def email_kinds(spark, at):
    """All stages of the rules; a null kind is an ambiguous message."""
    m = mail.messages(spark, at, "from_h", "subject").select(F.coalesce("from_h", F.lit("")).alias("f"), mime.decode_words(F.col("subject")).alias("s"))
    return m.select(routing.kind_by_rules(F.col("s"), F.col("f")).alias("r")).groupBy("r.kind", "r.rule_id").agg(F.count(F.lit(1)).alias("messages"))


@query(rf"""WITH m AS (SELECT k, lower(trim(CASE WHEN regexp_extract(from_h, '<([^<>]*)>\s*$', 1) <> '' THEN regexp_extract(from_h, '<([^<>]*)>\s*$', 1) ELSE coalesce(from_h, '') END)) AS f FROM {mail.FIRST}), r AS (SELECT source_id, lower(sender_match) AS v, lower(coalesce(alias_match, '')) AS a FROM {X.ROSTER.sql()} WHERE sender_match <> ''),
    h AS (SELECT k, source_id, v, CASE WHEN a <> '' THEN 1 ELSE 2 END AS rank FROM m JOIN r ON regexp_replace(f, '\+[^@]*@', '@') = v AND (a = '' OR a = regexp_extract(f, '\+([^@]*)@', 1)) UNION ALL SELECT k, source_id, v, 3 FROM m JOIN r ON a = '' AND contains(f, v)),
    b AS (SELECT k, source_id FROM h QUALIFY row_number() OVER (PARTITION BY k ORDER BY rank, length(v) DESC, source_id) = 1) SELECT b.source_id, count(*) AS messages FROM m LEFT JOIN b USING (k) GROUP BY 1""")  # fmt: skip
def roster_sources(spark, at):
    return routing.sources_of(mail.messages(spark, at, "from_h"), X.ROSTER.spark(spark), "from_h").groupBy("source_id").agg(F.count(F.lit(1)).alias("messages"))


SEARCH = 'in:anywhere newer_than:200d from:mailhop -subject:confirm -"verification code"'


@query(f"""SELECT k AS msg_id FROM (SELECT *, (SELECT max(ingested_at) FROM message_summary) AS now FROM {mail.FIRST}) WHERE ingested_at > now - INTERVAL 200 DAY AND contains(lower(coalesce(from_h, '')), 'mailhop') AND NOT contains(lower(coalesce(subject, '')), 'confirm')
    AND NOT (contains(lower(coalesce(subject, '')), 'verification code') OR contains(lower(coalesce(snippet, '')), 'verification code'))""")  # fmt: skip
def mail_search(spark, at):
    m = mail.messages(spark, at, "from_h", "to_h", "subject", "snippet", "ingested_at", "label_ids").withColumn("ingested_at", F.col("ingested_at").cast("timestamp"))
    now = table(spark, at, "message_summary").agg(F.max(F.col("ingested_at").cast("timestamp"))).scalar()
    return m.filter(search.predicate(SEARCH, now, "ingested_at")).select(F.col("k").alias("msg_id"))


@query(f"""SELECT min(msg_id) AS kept, count(*) AS copies FROM (SELECT msg_id, coalesce(nullif(message_id, ''), sha256(concat_ws(chr(1), coalesce(sender, ''), coalesce(subject, ''), coalesce(sent, '')))) AS g FROM {X.ALIAS_MAIL.sql()}) GROUP BY g HAVING count(*) > 1""")
def alias_groups(spark, at):
    """By Message-ID, else by sender, subject and date."""
    return deliveries.alias_groups(X.ALIAS_MAIL.spark(spark), "msg_id", "message_id", "sender", "subject", "sent").filter("copies > 1")


@query(rf"""WITH h AS (SELECT msg_id, regexp_replace(regexp_extract(raw, '^((?s:.*?))(\r?\n\r?\n|$)', 1), '\r?\n[ \t]+', ' ', 'g') AS b FROM {X.AUTH_MAIL.sql()})
    SELECT msg_id, lower(coalesce(nullif(regexp_extract(b, '(?im)^DKIM-Signature:[^\r\n]*\bd=([a-z0-9.-]+)', 1), ''), nullif(regexp_extract(b, '(?im)^Received-SPF: *pass[^\r\n]*domain of [^@\s)]*@?([a-z0-9.-]+)', 1), ''), nullif(regexp_extract(b, '(?im)^ARC-Authentication-Results:[^\r\n]*\bsmtp\.mailfrom=(?:[^@\s;]*@)?([a-z0-9.-]+)', 1), ''))) AS platform,
    trim(regexp_extract(b, '(?m)^Subject:[ \t]*([^\r\n]*)$', 1)) AS subject FROM h""")  # fmt: skip
def auth_platforms(spark, at):
    b = X.AUTH_MAIL.spark(spark).select("msg_id", text.header_block(F.col("raw")).alias("b"))
    return b.select("msg_id", text.sending_platform(F.col("b")).alias("platform"), text.exact_header(F.col("b"), "Subject").alias("subject"))


_FEEDS = X.NAMED_SEGMENTS.sql()


@query(f"SELECT segment, 'absent' AS problem FROM (SELECT DISTINCT segment FROM documents WHERE segment IS NOT NULL UNION SELECT DISTINCT segment FROM sources WHERE segment IS NOT NULL) WHERE segment NOT IN (SELECT segment FROM {_FEEDS} WHERE segment IS NOT NULL) UNION ALL SELECT segment, 'blank' FROM {_FEEDS} WHERE coalesce(trim(subscribe_email), '') = ''")
def missing_segments(spark, at):
    """Segments that rows name and a stated list of feeds lacks or has no address for (the table of segments lacks none)."""
    named = table(spark, at, "documents").select("segment").unionByName(table(spark, at, "sources").select("segment")).filter("segment IS NOT NULL").distinct()
    feeds = X.NAMED_SEGMENTS.spark(spark)
    absent = named.join(feeds, "segment", "left_anti").select("segment", F.lit("absent").alias("problem"))
    return absent.unionByName(feeds.filter(F.coalesce(F.trim("subscribe_email"), F.lit("")) == "").select("segment", F.lit("blank").alias("problem")))


@query("SELECT source_id, segment FROM sources WHERE coalesce(status, '') IN ('', 'to_subscribe') AND (segment = '3-Legal' OR segment IS NOT NULL)")
def unprocessed_sources(spark, at):
    return table(spark, at, "sources").filter(F.coalesce("status", F.lit("")).isin("", "to_subscribe") & F.col("segment").isNotNull()).select("source_id", "segment")


@query("SELECT batch_id, place FROM (SELECT batch_id, row_number() OVER (ORDER BY run_at DESC, batch_id) AS place FROM sync_log) WHERE place BETWEEN 6 AND 15")
def recent_runs(spark, at):
    """The second page of ten of the runs, the latest first, after the first five."""
    return selection.placed(table(spark, at, "sync_log").select("batch_id", "run_at"), [F.desc("run_at"), F.col("batch_id")], "place").filter("place BETWEEN 6 AND 15").select("batch_id", "place")


@query("SELECT batch_id, attempts, CASE WHEN last IN ('ok', 'done') THEN 'done' WHEN attempts < 3 THEN 'retry' ELSE 'given up' END AS state FROM (SELECT batch_id // 4 AS batch_id, count(*) AS attempts, arg_max(status, run_at) AS last FROM sync_log GROUP BY 1)")
def retry_states(spark, at):
    """Four runs in succession count as attempts at one window."""
    return stories.retry_queue(table(spark, at, "sync_log").select(F.expr("batch_id DIV 4").alias("batch_id"), "run_at", "status"), "batch_id", "run_at", "status")


@query("SELECT doc_id, row_number() OVER (ORDER BY coalesce(segment, ''), doc_id) AS place FROM documents")
def segment_order(spark, at):
    """The place of each document in the order of segments, with the id as the last resort."""
    d = table(spark, at, "documents").select("doc_id", F.coalesce("segment", F.lit("")).alias("s"))
    return selection.placed(d, [F.col("s"), F.col("doc_id")], "place").select("doc_id", "place")


@query("SELECT source_id, coalesce(nullif(trim(publisher), ''), '(No publisher)') AS publisher, coalesce(subscriber_estimate, 0) AS subscribers, coalesce(TRY_CAST(regexp_extract(newsletter_name, '([0-9]+)', 1) AS BIGINT), -1) AS number FROM sources")
def filled_sources(spark, at):
    """Missing fields with their defaults, numbers in texts or a default."""
    filled = F.coalesce(F.nullif(F.trim("publisher"), F.lit("")), F.lit("(No publisher)"))
    number = F.coalesce(F.regexp_extract("newsletter_name", "([0-9]+)", 1).try_cast("long"), F.lit(-1))
    return table(spark, at, "sources").select("source_id", filled.alias("publisher"), F.coalesce("subscriber_estimate", F.lit(0)).alias("subscribers"), number.alias("number"))


@query(rf"""SELECT segment, count(*) AS issues, CAST(max(ingested_at) AS DATE) AS last_day FROM (SELECT m.ingested_at, {mail._DECODED} AS s, coalesce(g.segment, 'unmatched') AS segment FROM {mail.FIRST} m LEFT JOIN (SELECT regexp_extract(lower(subscribe_email), '\+([a-z]+)@', 1) AS tag, min(segment) AS segment FROM segments GROUP BY 1) g
    ON g.tag = nullif(regexp_extract(lower(coalesce(nullif(trim(to_h), ''), nullif(trim(delivered_to), ''))), '\+([a-z]+)@', 1), '')) WHERE coalesce(trim(s), '') <> '' AND NOT regexp_matches(s, '{routing.CONFIRM.replace(chr(39), chr(39) * 2)}') GROUP BY segment""")  # fmt: skip
def delivering_segments(spark, at):
    """What is delivered to each segment: issues only, by their decoded subjects, wherever they lie."""
    m = mail.messages(spark, at, "to_h", "delivered_to", "subject", "ingested_at").withColumn("s", mime.decode_words(F.col("subject"))).filter(routing.is_issue(F.col("s")) == 1)
    routed = routing.by_tag(m, table(spark, at, "segments"), text.first_filled(F.col("to_h"), F.col("delivered_to")))
    return routed.groupBy("segment").agg(F.count(F.lit(1)).alias("issues"), F.to_date(F.max("ingested_at")).alias("last_day"))


# ---- sections and sponsors

PARTNERS, REFERRALS = ("Quokelo", "Yarravik"), ("mailhop.example", "meadowfoundry.example")
_TESTS = {
    "house": routing.HOUSE_BLOCKS, "label": routing.SPONSOR_LABELS, "offering": routing.OFFERINGS, "partner": tuple(f"{p}*" for p in PARTNERS), "referral": tuple(f"//{r}/" for r in REFERRALS),
}
_SECTIONS = rf"""(SELECT msg_id, unnest(range(len(p))) AS seq, unnest(p) AS section FROM (SELECT msg_id, {mail._PARTS} AS p FROM full_message WHERE length(body) > 0))"""
_REASONS = "list_filter([" + ", ".join(f"CASE WHEN {mail._any_sql('section', tuple(w.lower().replace(chr(39), chr(39) * 2) for w in words))} THEN '{n}' END" for n, words in _TESTS.items()) + "], lambda x: x IS NOT NULL)"


def sections(spark, at):
    """(msg_id, seq, section, reasons): the parts of each body and why a part is an advertisement."""
    m = table(spark, at, "full_message").filter(F.length("body") > 0)
    parts = m.select("msg_id", F.posexplode(mail.parts_of(F.col("body"))).alias("seq", "section"))
    return parts.withColumn("reasons", routing.sponsor_reasons(F.col("section"), PARTNERS, REFERRALS))


@query(f"SELECT array_to_string({_REASONS}, ',') AS reasons, count(*) AS sections, count(DISTINCT msg_id) AS messages FROM {_SECTIONS} GROUP BY 1")
def sponsor_sections(spark, at):
    s = sections(spark, at).select("msg_id", F.array_join("reasons", ",").alias("reasons"))
    return s.groupBy("reasons").agg(F.count(F.lit(1)).alias("sections"), F.count_distinct("msg_id").alias("messages"))


_PCT = r"(\d[\d,]*(?:\.\d+)?) ?(?:%|percent)"


@query(rf"""WITH s AS (SELECT msg_id, seq, section, len({_REASONS}) > 0 AS sponsored FROM {_SECTIONS}), f AS (SELECT msg_id, seq, sponsored, unnest(regexp_extract_all(section, '{_PCT}', 1)) AS value FROM s)
    SELECT count(*) FILTER (WHERE NOT sponsored) AS facts, count(*) FILTER (WHERE sponsored) AS held_back, (SELECT count(*) FROM f x WHERE NOT sponsored AND EXISTS (SELECT 1 FROM s WHERE s.msg_id = x.msg_id AND s.seq = x.seq AND s.sponsored)) AS leaked FROM f""")  # fmt: skip
def sponsor_leakage(spark, at):
    """Facts are drawn from sections that are no advertisement; leaked counts those that stand in one all the same, which must be 0."""
    s = durable(sections(spark, at))
    facts = lambda part: part.select("msg_id", "seq", F.explode(F.regexp_extract_all("section", F.lit(_PCT), F.lit(1))).alias("value"))
    kept, ads = facts(s.filter(F.size("reasons") == 0)), s.filter(F.size("reasons") > 0)
    count = lambda d, n: d.agg(F.count(F.lit(1)).alias(n))
    leaked = count(kept.join(ads.select("msg_id", "seq"), ["msg_id", "seq"], "left_semi"), "leaked")
    return count(kept, "facts").withColumn("held_back", count(facts(ads), "x").scalar()).withColumn("leaked", leaked.scalar())


# ---- facts and stories

_FACT_ENTITY = r"(?:^|[^\p{L}])([A-Z][a-z]{4,})(?:[^\p{L}]|$)"
_CLUSTER = r"list_sort(list_distinct(list_filter(regexp_split_to_array(lower(regexp_extract(text, '^\s*([^\n]*)', 1)), '[^\p{L}]+'), lambda w: w <> '')))"
_FACTS = rf"""(SELECT doc_id, source, array_to_string(cluster, ' ') AS cluster, entity, {corpus._UNIT.format("number")} AS unit, {corpus._VALUE.format("number")} AS v FROM (SELECT doc_id, source, cluster, entity, unnest(regexp_extract_all(line, '({text.NUMBER})', 1)) AS number FROM (SELECT doc_id, source, cluster, line, regexp_extract(line, '{_FACT_ENTITY}', 1) AS entity
    FROM (SELECT doc_id, source, {_CLUSTER} AS cluster, unnest(string_split(text, chr(10))) AS line FROM documents WHERE length(text) > 0)) WHERE entity <> ''))"""


def facts(spark, at):
    """(doc_id, source, cluster, entity, unit, v): the numbers of each line with the first entity named in it. Documents whose
    headlines have the same words, whatever their numbers, are one cluster."""
    head = F.regexp_extract("text", r"^\s*([^\n]*)", 1)
    cluster = F.array_join(F.array_sort(F.array_distinct(F.filter(F.split(F.lower(head), r"[^\p{L}]+"), lambda w: w != ""))), " ")
    lines = table(spark, at, "documents").filter(F.length("text") > 0).select("doc_id", "source", cluster.alias("cluster"), F.explode(F.split("text", "\n")).alias("line"))
    named = lines.withColumn("entity", F.regexp_extract("line", _FACT_ENTITY, 1)).filter("entity <> ''").select("doc_id", "source", "cluster", "entity", F.explode(text.numbers(F.col("line"))).alias("number"))
    return named.select("doc_id", "source", "cluster", "entity", text.number_unit(F.col("number")).alias("unit"), text.number_value(F.col("number")).alias("v"))


@query(f"""SELECT cluster, entity, unit, count(*) AS sources, string_agg(source || '=' || CAST(round(v * 100) AS BIGINT), '; ' ORDER BY source) AS values_by_source FROM (SELECT cluster, entity, unit, source, min(v) AS v FROM {_FACTS} WHERE v IS NOT NULL AND source IS NOT NULL GROUP BY ALL) GROUP BY cluster, entity, unit HAVING max(v) > min(v)""")
def cluster_conflicts(spark, at):
    found = stories.conflicts_by_unit(facts(spark, at), ("cluster", "entity", "unit"), "source", "v")
    shown = F.transform(F.map_entries("values_by_source"), lambda e: F.concat(e["key"], F.lit("="), F.round(e["value"] * 100).cast("long").cast("string")))
    return found.select("cluster", "entity", "unit", "sources", F.array_join(shown, "; ").alias("values_by_source"))


@query(f"""WITH n AS (SELECT cluster_id, min(doc_id) AS first_id, count(DISTINCT source) AS sources FROM {corpus._MEMBERS} GROUP BY cluster_id), f AS (SELECT doc_id, count(*) AS facts FROM {_FACTS} GROUP BY doc_id)
    SELECT cluster_id, unnest(list_filter([CASE WHEN sources < 1 THEN 'no source' END, CASE WHEN coalesce(facts, 0) < 1 THEN 'no fact' END], lambda x: x IS NOT NULL)) AS error FROM n LEFT JOIN f ON f.doc_id = n.first_id""")  # fmt: skip
def story_checks(spark, at):
    """Every story needs a source and a fact; its badges are those that follow from its coverage."""
    n = corpus._members(spark, at).groupBy("cluster_id").agg(F.min("doc_id").alias("first_id"), F.count_distinct("source").alias("sources"))
    f = facts(spark, at).groupBy(F.col("doc_id").alias("first_id")).agg(F.count(F.lit(1)).alias("facts"))
    zero = F.lit(0)
    s = n.join(f, "first_id", "left").select("cluster_id", "sources", "facts", zero.alias("sponsored_facts"), zero.alias("conflicts"), zero.alias("vendor_claims")).withColumn("badges", stories.badges())
    return stories.story_errors(s, "cluster_id")


_PLAIN = "lower(trim(regexp_replace(translate({0}, '“”„‘’«»', '\"\"\"''''\"\"'), '\\s+', ' ', 'g')))"


@query(rf"""SELECT fact_id, CASE WHEN coalesce(trim(evidence), '') = '' OR len(list_filter(regexp_split_to_array(evidence, '\s+'), lambda w: w <> '')) > 25 THEN 'dropped' WHEN coalesce(contains(section, evidence), false) THEN 'verified' WHEN coalesce(contains({_PLAIN.format('section')}, {_PLAIN.format('evidence')}), false) THEN 'repaired' ELSE 'dropped' END AS state FROM {X.CARD_EVIDENCE.sql()}""")
def evidence_repair(spark, at):
    return stories.repaired(X.CARD_EVIDENCE.spark(spark), "evidence", "section").select("fact_id", "state")


@query(f"""SELECT source, count(*) AS messages, round(count(*) FILTER (WHERE ok) / count(*), 6) AS verified_share, count(*) FILTER (WHERE ok) / count(*) >= 0.95 AS enough FROM (SELECT {mail.SENDER} AS source, coalesce(contains(f.body, m.snippet) AND length(m.snippet) > 0, false) AS ok FROM full_message f JOIN {mail.FIRST} m ON m.k = lower(f.msg_id)) GROUP BY source""")
def verified_share(spark, at):
    """Per source: how many messages show their snippet verbatim, and whether that is enough."""
    m = mail.messages(spark, at, "from_h", "snippet").select(F.col("k").alias("msg_id"), mail.sender_address("from_h").alias("source"), "snippet")
    bodies = table(spark, at, "full_message").select(canonical_id("msg_id").alias("msg_id"), "body")
    ok = F.coalesce((F.length("snippet") > 0) & F.contains("body", F.col("snippet")), F.lit(False))
    share = F.count_if(ok) / F.count(F.lit(1))
    return m.join(bodies, "msg_id").groupBy("source").agg(F.count(F.lit(1)).alias("messages"), F.round(share, 6).alias("verified_share"), (share >= stories.LEAST_VERIFIED).alias("enough"))


@query(f"""WITH a AS (SELECT delivery_id, k AS msg_id, subject FROM {mail.FIRST}), u AS (SELECT * FROM a UNION ALL SELECT delivery_id, {mail.K}, subject FROM message_summary), b AS (SELECT * FROM u QUALIFY row_number() OVER (PARTITION BY msg_id ORDER BY delivery_id) = 1)
    SELECT 'first only' AS side, count(*) AS rows FROM (SELECT * FROM a EXCEPT ALL SELECT * FROM b) UNION ALL SELECT 'second only', count(*) FROM (SELECT * FROM b EXCEPT ALL SELECT * FROM a)""")  # fmt: skip
def rerun_differences(spark, at):
    """One copy of each message, kept twice over: of the deliveries, and of what was kept with all deliveries again."""
    m = table(spark, at, "message_summary").select("delivery_id", "msg_id", "subject")
    once = durable(deliveries.keep_one(m))
    return stories.differences(once, deliveries.keep_one(once, m))


@query(f"""SELECT msg_id, 'changed' AS error FROM (SELECT {mail.K} AS msg_id, arg_min(coalesce(date_h, ''), delivery_id) AS a, arg_max(coalesce(date_h, ''), delivery_id) AS b FROM message_summary GROUP BY 1) WHERE a <> b""")
def archive_differences(spark, at):
    """An archive of the first deliveries against one regenerated from the last ones."""
    m = table(spark, at, "message_summary").select(canonical_id("msg_id").alias("msg_id"), "delivery_id", F.coalesce("date_h", F.lit("")).alias("date_h"))
    both = m.groupBy("msg_id").agg(F.min_by("date_h", "delivery_id").alias("a"), F.max_by("date_h", "delivery_id").alias("b"))
    return stories.archive_errors(both.select("msg_id", F.col("a").alias("date_h")), both.select("msg_id", F.col("b").alias("date_h")), "msg_id", "date_h")


_ENTITIES = r"""(SELECT DISTINCT doc_id, w AS entity FROM (SELECT doc_id, unnest(regexp_extract_all(text, '\p{L}+')) AS w FROM documents) WHERE regexp_full_match(w, '[A-Z][a-z]{4,}'))"""


def entities(spark, at):
    found = F.array_distinct(F.regexp_extract_all("text", F.lit(r"(?<!\p{L})([A-Z][a-z]{4,})(?!\p{L})"), F.lit(1)))
    return table(spark, at, "documents").select("doc_id", "issue_date", "source", found.alias("entities"))


@query(f"""SELECT entity, issue_date, n, lag(issue_date) OVER w AS prior_day, CAST(coalesce(sum(n) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS prior_n FROM (SELECT entity, issue_date, count(*) AS n FROM {_ENTITIES} JOIN documents USING (doc_id) WHERE issue_date IS NOT NULL GROUP BY ALL) WINDOW w AS (PARTITION BY entity ORDER BY issue_date)""")
def prior_coverage(spark, at):
    return stories.prior_days(entities(spark, at).select("issue_date", F.explode("entities").alias("entity")), "entity", "issue_date")


@query(f"""SELECT entity, CAST(date_trunc('month', issue_date) AS DATE) AS month, count(*) AS documents, count(DISTINCT source) AS sources, array_to_string(list_slice(list_sort(list(doc_id)), 1, 5), ',') AS first_ids FROM {_ENTITIES} JOIN documents USING (doc_id) WHERE issue_date IS NOT NULL GROUP BY ALL""")
def entity_view(spark, at):
    """What is said about each entity in each month: how much, by how many, and where to begin reading (the five smallest ids)."""
    e = entities(spark, at).filter("issue_date IS NOT NULL").select("doc_id", F.trunc("issue_date", "month").alias("month"), "source", F.explode("entities").alias("entity"))
    sums = e.groupBy("entity", "month").agg(F.count(F.lit(1)).alias("documents"), F.count_distinct("source").alias("sources"))
    first = selection.top_per(e.select(F.struct("entity", "month").alias("g"), "doc_id"), "g", [F.col("doc_id")], 5).groupBy("g").agg(F.array_sort(F.collect_list("doc_id")).alias("ids"))
    return sums.join(first.select("g.*", F.array_join(F.transform("ids", lambda i: i.cast("string")), ",").alias("first_ids")), ["entity", "month"])


@query("SELECT source, segment, issue_date, count(*) AS sends FROM documents WHERE source IS NOT NULL AND segment IS NOT NULL AND issue_date IS NOT NULL GROUP BY ALL HAVING count(*) > 1")
def double_sends(spark, at):
    d = table(spark, at, "documents").filter("source IS NOT NULL AND segment IS NOT NULL AND issue_date IS NOT NULL")
    return stories.repeated_sends(d, "source", "segment", "issue_date")


_BRAND = r"regexp_replace(regexp_replace(regexp_extract(lower({0}), '([^.]+)\.[^.]+$', 1), '^(?:get|the|join|try|read)', ''), '(?:hq|mail|news|media)$', '')"


@query(f"SELECT cluster_id, count(DISTINCT {_BRAND.format('source')}) AS brands, count(DISTINCT source) AS sources FROM {corpus._MEMBERS} GROUP BY cluster_id HAVING count(*) > 1")
def coverage_by_brand(spark, at):
    """Coverage counted by brand, that is the core of the source's host, beside coverage by source."""
    m = corpus._members(spark, at)
    brand = F.regexp_replace(F.regexp_replace(F.regexp_extract(F.lower("source"), r"([^.]+)\.[^.]+$", 1), "^(?:get|the|join|try|read)", ""), "(?:hq|mail|news|media)$", "")
    c = m.groupBy("cluster_id").agg(F.count_distinct(brand).alias("brands"), F.count_distinct("source").alias("sources"), F.count(F.lit(1)).alias("n"))
    return c.filter("n > 1").drop("n")


@query(f"""SELECT source, count(*) AS documents, count(*) FILTER (WHERE coverage_n >= 2) AS selected, round(count(*) FILTER (WHERE coverage_n >= 2) / count(*), 6) AS share FROM {corpus._MEMBERS} JOIN (SELECT cluster_id, count(DISTINCT source) AS coverage_n FROM {corpus._MEMBERS} GROUP BY 1) USING (cluster_id) GROUP BY source""")
def selected_share(spark, at):
    """The share of a source's documents that reach the cut, here stories that two sources or more cover."""
    m = durable(corpus._members(spark, at))
    cover = m.groupBy("cluster_id").agg(F.count_distinct("source").alias("coverage_n"))
    x = m.join(cover, "cluster_id").groupBy("source").agg(F.count(F.lit(1)).alias("documents"), F.count_if(F.col("coverage_n") >= 2).alias("selected"))
    return x.withColumn("share", F.round(F.col("selected") / F.col("documents"), 6))


# ---- links

_CANON = r"""(SELECT doc_id, lower(start) || substring(head, length(start) + 1) || CASE WHEN len(kept) > 0 THEN '?' || array_to_string(kept, '&') ELSE '' END AS url FROM (SELECT *, regexp_extract(head, '^([A-Za-z][A-Za-z0-9+.-]*://[^/]*)', 1) AS start FROM (SELECT doc_id, regexp_replace(string_split(bare, '?')[1], '/+$', '') AS head,
    list_sort(list_filter(string_split(CASE WHEN contains(bare, '?') THEN substring(bare, strpos(bare, '?') + 1) ELSE '' END, '&'), lambda x: x <> '' AND NOT regexp_matches(x, '^(?:utm_[^=]*|gclid|fbclid|mc_cid|mc_eid)(?:=|$)'))) AS kept FROM (SELECT doc_id, regexp_replace(trim(url), '#.*$', '') AS bare FROM """ + corpus._URLS + """))))"""


_BARE = "regexp_replace(trim({0}), '#.*$', '')"
_HEAD = f"regexp_replace(string_split({_BARE}, '?')[1], '/+$', '')"
_START = f"regexp_extract({_HEAD}, '^([A-Za-z][A-Za-z0-9+.-]*://[^/]*)', 1)"
_KEPT = f"array_to_string(list_sort(list_filter(string_split(CASE WHEN contains({_BARE}, '?') THEN substring({_BARE}, strpos({_BARE}, '?') + 1) ELSE '' END, '&'), lambda x: x <> '' AND NOT regexp_matches(x, '^(?:utm_[^=]*|gclid|fbclid|mc_cid|mc_eid)(?:=|$)'))), '&')"
_CANON_OF = f"lower({_START}) || substring({_HEAD}, length({_START}) + 1) || CASE WHEN {_KEPT} <> '' THEN '?' || {_KEPT} ELSE '' END"


@query(f"SELECT url, min(doc_id) AS first_id, count(*) AS links, count(DISTINCT doc_id) AS documents FROM {_CANON} GROUP BY url")
def distinct_links(spark, at):
    """Links once each, after they have been brought to one form."""
    links = corpus.link_extract(spark, at).select("doc_id", urls.canonical(F.col("url")).alias("url"))
    return links.groupBy("url").agg(F.min("doc_id").alias("first_id"), F.count(F.lit(1)).alias("links"), F.count_distinct("doc_id").alias("documents"))


@query(f"SELECT link_id, CASE WHEN http_status IS NULL THEN 'unchecked' WHEN NOT http_status BETWEEN 200 AND 399 THEN 'dead' WHEN checked_ms > 5000 THEN 'slow' ELSE 'ok' END AS state FROM {X.STATUSES.sql()}")
def link_states(spark, at):
    """The engine requests no link: a status is given from outside."""
    return X.STATUSES.spark(spark).select("link_id", text.link_state(F.col("http_status"), F.col("checked_ms")).alias("state"))


@query(f"SELECT token, date_diff('day', CAST(issued AS DATE), DATE '2025-01-08') AS age, coalesce(date_diff('day', CAST(issued AS DATE), DATE '2025-01-08') >= 6, true) AS renew FROM {X.TOKENS.sql()}")
def token_ages(spark, at):
    age = F.datediff(F.lit("2025-01-08").cast("date"), F.try_to_date("issued")).cast("long")
    return X.TOKENS.spark(spark).select("token", age.alias("age"), F.coalesce(age >= 6, F.lit(True)).alias("renew"))


@query(f"SELECT doc_id, url, CASE WHEN host IN ('go.example', 'meadowfoundry.example') THEN 'tracking' WHEN url <> canonical THEN 'not canonical' END AS problem FROM (SELECT u.doc_id, u.url, {corpus._HOST.replace('url', 'u.url')} AS host, {_CANON_OF.format('u.url')} AS canonical FROM {corpus._URLS} u) WHERE host IN ('go.example', 'meadowfoundry.example') OR url <> canonical")
def link_problems(spark, at):
    """Links that aren't in their one form, or go through a wrapper that hides their target."""
    u = corpus.link_extract(spark, at)
    problem = F.when(urls.is_tracking(F.col("url"), ["go.example", "meadowfoundry.example"]), "tracking").when(F.col("url") != urls.canonical(F.col("url")), "not canonical")
    return u.withColumn("problem", problem).filter("problem IS NOT NULL")


# ---- structured values

SIX = {"claims": "claim_text", "quotes": "quote_text", "links": "url", "entities": "name", "stats": "value", "topics": "topic"}
EXTRACTION = ", ".join(f"{t} array<struct<{c} string>>" for t, c in SIX.items())


@query(" UNION ALL ".join(f"SELECT '{t}' AS table_name, msg_id, json_extract_string(x, '$.{c}') AS main FROM (SELECT msg_id, unnest(CAST(json_extract(payload, '$.{t}[*]') AS JSON[])) AS x FROM {X.FULL_EXTRACTIONS.sql()} WHERE json_valid(payload))" for t, c in SIX.items()))
def extraction_tables(spark, at):
    """One extraction fans out into six tables; shown as one, with the name of each."""
    parsed = durable(X.FULL_EXTRACTIONS.spark(spark).select("msg_id", F.from_json("payload", EXTRACTION).alias("x")))
    out = None
    for name, main in SIX.items():
        part = parsed.select(F.lit(name).alias("table_name"), "msg_id", F.explode(f"x.{name}").alias("e")).select("table_name", "msg_id", F.col(f"e.{main}").alias("main"))
        out = part if out is None else out.unionByName(part)
    return out


@query()
def repaired_extractions(spark, at):
    """Broken extractions after one repair; SQL has no such step, see the tests."""
    fixed = X.FULL_EXTRACTIONS.spark(spark).select("msg_id", jsons.repair(F.col("payload")).alias("fixed"))
    return fixed.select("msg_id", "fixed", F.from_json("fixed", EXTRACTION).getField("topics").getField("topic").alias("topics"))


@query(f"SELECT module_id, CASE type WHEN 'number' THEN CASE WHEN json_valid(payload) THEN json_extract_string(payload, '$.unit') END ELSE CASE WHEN json_valid(payload) THEN json_extract_string(payload, '$.name') END END AS label, CASE WHEN json_valid(payload) THEN CAST(json_extract(payload, CASE type WHEN 'number' THEN '$.value' WHEN 'mover' THEN '$.pct' ELSE '$.stars' END) AS DOUBLE) END AS amount FROM {X.MODULES.sql()}")
def module_payloads(spark, at):
    """Payloads whose fields depend on the module's type."""
    p = F.col("payload")
    label = F.when(F.col("type") == "number", text.payload_value(p, "$.unit", "string")).otherwise(text.payload_value(p, "$.name", "string"))
    amount = F.when(F.col("type") == "number", text.payload_value(p, "$.value", "double")).when(F.col("type") == "mover", text.payload_value(p, "$.pct", "double")).otherwise(text.payload_value(p, "$.stars", "double"))
    return X.MODULES.spark(spark).select("module_id", label.alias("label"), amount.alias("amount"))


@query(f"SELECT event_id, array_to_string(CASE WHEN json_valid(attendees) THEN list_filter(list_transform(CAST(json_extract(attendees, '$[*]') AS JSON[]), lambda x: json_extract_string(x, '$.email')), lambda e: e <> '') ELSE [] END, ',') AS emails FROM {X.ATTENDEES.sql()}")
def attendee_lists(spark, at):
    return X.ATTENDEES.spark(spark).select("event_id", F.array_join(text.filled_emails(F.col("attendees")), ",").alias("emails"))


@query(rf"""WITH a AS (SELECT n, unnest(range(len(p))) AS i, unnest(p) AS arg FROM (SELECT n, string_split(line, ' ') AS p FROM {X.CLI_ARGS.sql()})), o AS (SELECT n, i, regexp_extract(arg, '^--([^=]+)', 1) AS k, CASE WHEN contains(arg, '=') THEN substring(arg, strpos(arg, '=') + 1) ELSE 'true' END AS v FROM a WHERE regexp_matches(arg, '^--[^=]+'))
    SELECT n, k AS name, arg_max(v, i) AS value FROM o GROUP BY n, k""")  # fmt: skip
def option_values(spark, at):
    return X.CLI_ARGS.spark(spark).select("n", F.explode(search.options(F.split("line", " "))).alias("name", "value"))


TEMPLATE = "{{source}}: {{n_chars}} characters in {{lang}} ({{missing}})"


@query("SELECT doc_id, replace(replace(replace('" + TEMPLATE + "', '{{source}}', coalesce(source, '')), '{{n_chars}}', coalesce(CAST(n_chars AS VARCHAR), '')), '{{lang}}', coalesce(lang, '')) AS line FROM documents")
def filled_templates(spark, at):
    return table(spark, at, "documents").select("doc_id", search.filled(F.lit(TEMPLATE), {"source": F.col("source"), "n_chars": F.col("n_chars"), "lang": F.col("lang")}).alias("line"))


@query("SELECT m.segment, m.messages, s.segment_label AS label FROM (SELECT segment, count(*) AS messages FROM documents WHERE segment IS NOT NULL GROUP BY segment) m LEFT JOIN segments s USING (segment)")
def labelled_segments(spark, at):
    """Rows by key looked up in a dictionary that is one value: the feeds, a dimension of a few rows."""
    known = table(spark, at, "segments").agg(F.map_from_entries(F.array_sort(F.collect_set(F.struct("segment", "segment_label")))).alias("m")).scalar()
    n = table(spark, at, "documents").filter("segment IS NOT NULL").groupBy("segment").agg(F.count(F.lit(1)).alias("messages"))
    return n.select("segment", "messages", F.try_element_at(known, F.col("segment")).alias("label"))


_ARTIFACT = r"""(SELECT segment, source, issue_date, string_agg(head, chr(10) ORDER BY doc_id) AS heads, string_agg('- ' || doc_id || ' < ' || source, chr(10) ORDER BY doc_id) AS trace, string_agg(CASE WHEN head = '' THEN '- ' || doc_id || ': no headline' END, chr(10) ORDER BY doc_id) AS wrong
    FROM (SELECT doc_id, segment, source, issue_date, coalesce(regexp_extract(text, '^\\s*([^\\n]*)', 1), '') AS head FROM documents WHERE segment IS NOT NULL AND source IS NOT NULL AND issue_date IS NOT NULL) GROUP BY ALL)""".replace("\\\\", "\\")


@query(f"""SELECT segment, source, issue_date, unnest(['txt', 'validation.md', 'trace.md']) AS kind, sha256(unnest([segment || ' ' || source || ' ' || issue_date || chr(10) || heads, coalesce(wrong, 'no errors'), trace])) AS content_hash FROM {_ARTIFACT}""")
def issue_artifacts(spark, at):
    """What is written for each issue, as hashes; the JSON is `issue_json`, the HTML has no SQL (see the tests)."""
    d = table(spark, at, "documents").filter("segment IS NOT NULL AND source IS NOT NULL AND issue_date IS NOT NULL")
    d = d.select("doc_id", "segment", "source", "issue_date", F.coalesce(F.regexp_extract("text", r"^\s*([^\n]*)", 1), F.lit("")).alias("headline"))
    errors = d.filter("headline = ''").select("doc_id", F.lit("no headline").alias("error"))
    made = issues.artifacts(d, ("segment", "source", "issue_date"), "doc_id", "headline", "source", errors)
    return made.filter(F.col("kind").isin("txt", "validation.md", "trace.md")).select("segment", "source", "issue_date", "kind", text.content_hash(F.col("content")).alias("content_hash"))


# ---- seams


def _percents(s):
    return s.select("msg_id", "seq", F.explode(F.regexp_extract_all("section", F.lit(_PCT), F.lit(1))).alias("value"))


def _openings(s):
    return s.select("msg_id", "seq", F.regexp_extract("section", r"^\s*([^\n]*)", 1).alias("headline")).filter("headline <> ''")


@query(rf"""WITH s AS (SELECT msg_id, seq, section FROM {_SECTIONS} WHERE len({_REASONS}) = 0) SELECT 'percent' AS extractor, count(*) AS cards, count(DISTINCT msg_id) AS messages FROM (SELECT msg_id, unnest(regexp_extract_all(section, '{_PCT}', 1)) FROM s)
    UNION ALL SELECT 'opening', count(*), count(DISTINCT msg_id) FROM s WHERE regexp_extract(section, '^\s*([^\n]*)', 1) <> ''""")  # fmt: skip
def extracted_cards(spark, at):
    """The seam for extractors: rules here, a model in their place elsewhere; advertisements are never handed to them."""
    cards = stories.extracted(sections(spark, at).filter(F.size("reasons") == 0), {"percent": _percents, "opening": _openings})
    return cards.groupBy("extractor").agg(F.count(F.lit(1)).alias("cards"), F.count_distinct("msg_id").alias("messages"))


@query(f"""WITH e AS (SELECT doc_id, list(entity) AS es FROM {_ENTITIES} GROUP BY doc_id), p AS (SELECT a, b, round(c / (na + nb - c), 6) AS similarity FROM {corpus._PAIRS}), j AS (SELECT p.*, len(list_intersect(coalesce(x.es, []), coalesce(y.es, []))) AS common FROM p LEFT JOIN e x ON x.doc_id = a LEFT JOIN e y ON y.doc_id = b)
    SELECT a, b, common, CASE WHEN similarity >= 0.8 OR common >= 2 THEN 'same' ELSE 'different' END AS verdict, CASE WHEN similarity >= 0.8 THEN 'headlines' WHEN common >= 2 THEN 'entities' ELSE 'neither' END AS reason FROM j""")  # fmt: skip
def judged_pairs(spark, at):
    """The seam for a judge: the rule in its place looks at headlines and at the entities that two documents have in common."""
    found = corpus.jaccard_pairs(spark, at)
    e = entities(spark, at).select("doc_id", "entities")
    both = found.join(e.select(F.col("doc_id").alias("a"), F.col("entities").alias("x")), "a").join(e.select(F.col("doc_id").alias("b"), F.col("entities").alias("y")), "b")
    return stories.judged(both.withColumn("common", F.size(F.array_intersect("x", "y")).cast("long"))).select("a", "b", "common", "verdict", "reason")
