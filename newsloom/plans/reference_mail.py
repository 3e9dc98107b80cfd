"""Queries over mail: headers, routing, classification, tracker, delivery windows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import window as W

from newsloom.functions import dates, text
from newsloom.operators import checks, ingest, routing, timelines
from newsloom.plans import fixtures as X
from newsloom.sources import mime
from newsloom.sources.tables import canonical_id, sender_address, table

QUERIES: dict = {}
ORACLE: dict[str, str] = {}
K = r"lower(regexp_replace(msg_id, '\s+', '', 'g'))"
#: One row per message: the first delivery.
FIRST = f"(SELECT * FROM (SELECT *, {K} AS k, row_number() OVER (PARTITION BY {K} ORDER BY delivery_id) AS rn FROM message_summary) WHERE rn = 1)"
SENDER = r"regexp_replace(lower(trim(CASE WHEN regexp_extract(from_h, '<([^<>]*)>\s*$', 1) <> '' THEN regexp_extract(from_h, '<([^<>]*)>\s*$', 1) ELSE from_h END)), '\+[^@]*@', '@')"


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLE[f.__name__] = sql
        return f

    return add


def messages(spark: SparkSession, at: str, *columns: str) -> DataFrame:
    """The first delivery of each message, reduced by an aggregate that combines on the map side."""
    df = table(spark, at, "message_summary").select(canonical_id("msg_id").alias("k"), "delivery_id", *columns)
    return df.groupBy("k").agg(F.min_by(F.struct("delivery_id", *columns), "delivery_id").alias("r")).select("k", "r.*")


@query(f"SELECT count(*) AS deliveries, count(DISTINCT {K}) AS messages, count(DISTINCT nullif(thread_id, '')) AS threads FROM message_summary")
def mailbox_profile(spark, at):
    df = table(spark, at, "message_summary")
    return df.agg(F.count(F.lit(1)).alias("deliveries"), F.count_distinct(canonical_id("msg_id")).alias("messages"), F.count_distinct(F.nullif("thread_id", F.lit(""))).alias("threads"))


@query(f"SELECT label, count(*) AS deliveries, count(DISTINCT k) AS messages FROM (SELECT {K} AS k, unnest(label_ids) AS label FROM message_summary) GROUP BY label")
def label_counts(spark, at):
    df = table(spark, at, "message_summary").select(canonical_id("msg_id").alias("k"), F.explode("label_ids").alias("label"))
    return df.groupBy("label").agg(F.count(F.lit(1)).alias("deliveries"), F.count_distinct("k").alias("messages"))


@query(rf"""WITH h AS (SELECT msg_id, regexp_replace(regexp_extract(raw, '^((?s:.*?))(\r?\n\r?\n|$)', 1), '\r?\n[ \t]+', ' ', 'g') AS b FROM {X.RAW_MAIL.sql()}),
    p AS (SELECT msg_id, trim(regexp_extract(b, '(?im)^From:[ \t]*([^\r\n]*)$', 1)) AS f, trim(regexp_extract(b, '(?im)^Subject:[ \t]*([^\r\n]*)$', 1)) AS subject,
        coalesce(nullif(trim(regexp_extract(b, '(?im)^To:[ \t]*([^\r\n]*)$', 1)), ''), nullif(trim(regexp_extract(b, '(?im)^Delivered-To:[ \t]*([^\r\n]*)$', 1)), '')) AS sent_to FROM h)
    SELECT msg_id, lower(trim(CASE WHEN regexp_extract(f, '<([^>]+)>', 1) = '' THEN f ELSE regexp_extract(f, '<([^>]+)>', 1) END)) AS address,
        CASE WHEN contains(f, '<') THEN trim(replace(regexp_extract(f, '^([^<]*)<', 1), '"', '')) ELSE trim(f) END AS shown, subject, sent_to FROM p""")  # fmt: skip
def header_parse(spark, at):
    b = X.RAW_MAIL.spark(spark).withColumn("b", text.header_block(F.col("raw")))
    p = b.select("msg_id", *(text.header(F.col("b"), h).alias(n) for h, n in (("From", "f"), ("Subject", "subject"), ("To", "t"), ("Delivered-To", "d"))))
    return p.select("msg_id", text.address_of(F.col("f")).alias("address"), text.shown_name(F.col("f")).alias("shown"), "subject", text.first_filled(F.col("t"), F.col("d")).alias("sent_to"))


@query(rf"""SELECT coalesce(s.segment, 'unmatched') AS segment, count(*) AS messages FROM {FIRST} m
    LEFT JOIN (SELECT regexp_extract(lower(subscribe_email), '\+([a-z]+)@', 1) AS tag, min(segment) AS segment FROM segments GROUP BY 1) s
    ON s.tag = nullif(regexp_extract(lower(coalesce(nullif(trim(to_h), ''), nullif(trim(delivered_to), ''))), '\+([a-z]+)@', 1), '') GROUP BY 1""")  # fmt: skip
def route_by_tag(spark, at):
    m = messages(spark, at, "to_h", "delivered_to")
    return routing.by_tag(m, table(spark, at, "segments"), text.first_filled(F.col("to_h"), F.col("delivered_to"))).groupBy("segment").agg(F.count(F.lit(1)).alias("messages"))


@query(f"""WITH r AS {X.RULES.sql()}, hits AS (SELECT m.k, r.label FROM {FIRST} m JOIN r ON CASE WHEN r.field = 'to' THEN lower(m.delivered_to) = lower(r.value) ELSE contains(lower(m.from_h), lower(r.value)) END),
    sets AS (SELECT k, list_sort(list(DISTINCT label)) AS labels FROM hits GROUP BY k) SELECT array_to_string(labels, ' | ') AS labels, count(*) AS messages FROM sets GROUP BY 1""")  # fmt: skip
def rule_labels(spark, at):
    found = routing.labels_by_rules(messages(spark, at, "from_h", "delivered_to"), X.RULES.spark(spark), "k", "from_h", "delivered_to")
    return found.select(F.array_join("labels", " | ").alias("labels")).groupBy("labels").agg(F.count(F.lit(1)).alias("messages"))


@query(rf"""SELECT slug, count(*) AS messages, min(path) AS first_path FROM (SELECT CASE WHEN coalesce(n, '') = '' THEN 'x' ELSE substring(regexp_replace(regexp_replace(lower(n), '[^a-z0-9]+', '-', 'g'), '^-|-$', '', 'g'), 1, 28) END AS slug,
    concat('eml/', CASE WHEN coalesce(n, '') = '' THEN 'x' ELSE substring(regexp_replace(regexp_replace(lower(n), '[^a-z0-9]+', '-', 'g'), '^-|-$', '', 'g'), 1, 28) END, '__', k, '.eml') AS path
    FROM (SELECT k, CASE WHEN contains(from_h, '<') THEN trim(replace(regexp_extract(from_h, '^([^<]*)<', 1), '"', '')) ELSE trim(from_h) END AS n FROM {FIRST})) GROUP BY slug""")  # fmt: skip
def archive_paths(spark, at):
    s = messages(spark, at, "from_h").withColumn("slug", text.slug(text.shown_name(F.col("from_h"))))
    return s.withColumn("path", F.concat(F.lit("eml/"), "slug", F.lit("__"), "k", F.lit(".eml"))).groupBy("slug").agg(F.count(F.lit(1)).alias("messages"), F.min("path").alias("first_path"))


_DECODED = r"CASE WHEN regexp_matches(subject, '(?i)^\s*=\?utf-8\?b\?[A-Za-z0-9+/=]*\?=\s*$') THEN decode(from_base64(regexp_extract(subject, '(?i)^\s*=\?utf-8\?b\?([A-Za-z0-9+/=]*)\?=\s*$', 1))) ELSE subject END"


def _kind_sql(subject: str) -> str:
    cases = " ".join(f"WHEN regexp_matches({subject}, '{p.replace(chr(39), chr(39) * 2)}') THEN '{n}'" for n, p in routing.KINDS)
    return f"CASE WHEN coalesce(trim({subject}), '') = '' THEN 'other' {cases} ELSE 'issue' END"


@query(f"""SELECT kind, is_issue, count(*) AS messages FROM (SELECT {_kind_sql('s')} AS kind, CASE WHEN coalesce(trim(s), '') = '' THEN 0 WHEN regexp_matches(s, '{routing.CONFIRM.replace(chr(39), chr(39) * 2)}') THEN 0 ELSE 1 END AS is_issue
    FROM (SELECT {_DECODED} AS s FROM {FIRST})) GROUP BY ALL""")  # fmt: skip
def issue_kinds(spark, at):
    s = messages(spark, at, "subject").select(mime.decode_words(F.col("subject")).alias("s"))
    return s.select(routing.kind(F.col("s")).alias("kind"), routing.is_issue(F.col("s")).alias("is_issue")).groupBy("kind", "is_issue").agg(F.count(F.lit(1)).alias("messages"))


@query(f"SELECT k AS msg_id, sender FROM (SELECT k, {SENDER} AS sender, {_DECODED} AS s FROM {FIRST}) WHERE {_kind_sql('s')} = 'engagement_check'")
def engagement_alerts(spark, at):
    m = messages(spark, at, "from_h", "subject").withColumn("s", mime.decode_words(F.col("subject")))
    return m.filter(routing.kind(F.col("s")) == "engagement_check").select(F.col("k").alias("msg_id"), sender_address("from_h").alias("sender"))


_EMOJI = r"[\x{1F000}-\x{1FAFF}\x{2600}-\x{27BF}\x{2B00}-\x{2BFF}\x{FE0F}\x{200D}]+"


@query(rf"""WITH r AS (SELECT k, subject, regexp_replace(subject, '^(?:Fwd: )?(?:Plus!|(?:[^:;,]* )?[0-9]+:) *', '') AS rest FROM {FIRST}),
    l AS (SELECT k, CASE WHEN contains(rest, ';') THEN string_split(rest, ';') WHEN regexp_matches(rest, ',.*,') OR (rest <> subject AND contains(rest, ',')) THEN list_transform(string_split(regexp_replace(rest, ',([0-9]{{3}})\b', chr(1) || '\1', 'g'), ','), lambda x: replace(x, chr(1), ','))
        WHEN regexp_matches(rest, '{_EMOJI}[^,;]*{_EMOJI}[^,;]*{_EMOJI}') THEN regexp_split_to_array(rest, '{_EMOJI}') END AS parts FROM r),
    t AS (SELECT k, list_filter(list_transform(parts, lambda x: trim(regexp_replace(x, '^\s*and |{_EMOJI}', '', 'g'))), lambda x: x <> '') AS t FROM l)
    SELECT k AS msg_id, topic_no, topic FROM (SELECT k, unnest(t) AS topic, unnest(range(len(t))) AS topic_no FROM t)""")  # fmt: skip
def subject_topics(spark, at):
    m = messages(spark, at, "subject")
    return m.select(F.col("k").alias("msg_id"), F.posexplode(text.listed_topics(F.col("subject"))).alias("topic_no", "topic")).withColumn("topic_no", F.col("topic_no").cast("long"))


_MOVER_SQL = text.MOVER_RE2.replace("'", "''")
_MOVES = rf"""(SELECT k, s, unnest(range(len(v))) AS mover_no, unnest(nm) AS name, unnest(up) AS verb, unnest(s1) || unnest(s2) AS sign, CAST(replace(unnest(v), ',', '') AS DOUBLE) AS v, nullif(trim(unnest(why)), '') AS reason FROM (SELECT k, {SENDER} AS s,
    {', '.join(f"regexp_extract_all(subject, '{_MOVER_SQL}', {i}) AS {n}" for i, n in ((1, 'nm'), (2, 'up'), (3, 's1'), (4, 's2'), (5, 'v'), (6, 'why')))} FROM {FIRST} WHERE contains(subject, '%')))"""
_DOWN_SQL = rf"(regexp_full_match(verb, '{text.DOWN}') OR sign IN ('−', '–', '-', '▼'))"


@query(f"SELECT k AS msg_id, mover_no, name, CASE WHEN {_DOWN_SQL} THEN -v ELSE v END AS pct, CASE WHEN {_DOWN_SQL} THEN 'down' ELSE 'up' END AS direction, reason FROM {_MOVES}")
def mover_rows(spark, at):
    m = messages(spark, at, "subject").filter(F.contains("subject", F.lit("%")))
    return m.select(F.col("k").alias("msg_id"), F.posexplode(text.movers(F.col("subject"))).alias("mover_no", "m")).select("msg_id", F.col("mover_no").cast("long").alias("mover_no"), "m.*")


@query(rf"""SELECT company, count(*) AS deals, CAST(sum(v * CASE u WHEN 'K' THEN 1000 WHEN 'B' THEN 1000000000 WHEN 'billion' THEN 1000000000 WHEN 'T' THEN 1000000000000 WHEN '' THEN 1 ELSE 1000000 END) AS BIGINT) AS amount FROM (SELECT trim(regexp_extract(subject, '{text.DEAL}', 1)) AS company,
    TRY_CAST(replace(regexp_extract(subject, '{text.DEAL}', 2), ',', '') AS DECIMAL(18, 4)) AS v, regexp_extract(subject, '{text.DEAL}', 3) AS u FROM {FIRST} WHERE regexp_matches(subject, '{text.DEAL}')) GROUP BY company""")  # fmt: skip
def deal_rows(spark, at):
    m = messages(spark, at, "subject").filter(F.col("subject").rlike(text.DEAL)).select(text.subject_deal(F.col("subject")).alias("d"))
    return m.groupBy("d.company").agg(F.count(F.lit(1)).alias("deals"), F.sum("d.amount").cast("long").alias("amount"))


@query(r"""SELECT minutes, count(*) AS issues FROM (SELECT CAST(regexp_extract(body, '(?i)\b(\d+) min(?:ute)? read\b', 1) AS BIGINT) AS minutes FROM full_message WHERE regexp_matches(body, '(?i)\b(\d+) min(?:ute)? read\b')) GROUP BY minutes""")
def read_labels(spark, at):
    m = table(spark, at, "full_message").select(text.read_label(F.col("body")).alias("minutes")).filter("minutes IS NOT NULL")
    return m.groupBy("minutes").agg(F.count(F.lit(1)).alias("issues"))


@query(rf"""SELECT source_id, coalesce(expected_next_check, CAST(date_subscribed + CAST(coalesce(MAP {{{', '.join(f"'{k}': {v}" for k, v in dates.CHECK_DAYS.items())}}}[lower(trim(send_frequency))], {dates.DEFAULT_DAYS}) AS INT) AS DATE)) AS next_check FROM sources""")
def next_check_dates(spark, at):
    s = table(spark, at, "sources")
    return s.select("source_id", dates.filled_check(F.col("expected_next_check"), F.col("date_subscribed"), F.col("send_frequency")).alias("next_check"))


@query("""SELECT coalesce(segment, '(all)') AS segment, coalesce(status, '(all)') AS status, count(*) AS newsletters FROM sources WHERE segment IS NOT NULL AND status IS NOT NULL GROUP BY ROLLUP (segment, status)""")
def status_rollup(spark, at):
    s = table(spark, at, "sources").filter("segment IS NOT NULL AND status IS NOT NULL")
    return s.rollup("segment", "status").agg(F.count(F.lit(1)).alias("newsletters")).select(F.coalesce("segment", F.lit("(all)")).alias("segment"), F.coalesce("status", F.lit("(all)")).alias("status"), "newsletters")


@query("""SELECT g.segment, g.segment_label, count(s.source_id) AS newsletters, CAST(sum(s.subscriber_estimate) AS BIGINT) AS subscribers, count(DISTINCT s.publisher) AS publishers FROM segments g LEFT JOIN sources s USING (segment) GROUP BY ALL""")
def tracker_segments(spark, at):
    g, s = table(spark, at, "segments"), table(spark, at, "sources")
    joined = g.join(s.select("segment", "source_id", "subscriber_estimate", "publisher"), "segment", "left")
    return joined.groupBy("segment", "segment_label").agg(F.count("source_id").alias("newsletters"), F.sum("subscriber_estimate").alias("subscribers"), F.count_distinct("publisher").alias("publishers"))


@query("""SELECT segment, 'documents only' AS side FROM (SELECT segment FROM documents WHERE segment IS NOT NULL EXCEPT SELECT segment FROM segments) UNION ALL SELECT segment, 'both' FROM (SELECT segment FROM documents INTERSECT SELECT segment FROM segments)
    UNION ALL SELECT segment, 'segments only' FROM (SELECT segment FROM segments EXCEPT SELECT segment FROM documents)""")  # fmt: skip
def segment_sets(spark, at):
    d, s = table(spark, at, "documents").select("segment").filter("segment IS NOT NULL"), table(spark, at, "segments").select("segment")
    side = lambda df, n: df.withColumn("side", F.lit(n))
    return side(d.subtract(s), "documents only").unionByName(side(d.intersect(s), "both")).unionByName(side(s.subtract(d), "segments only"))


@query(f"""SELECT min(k) AS kept, count(*) AS copies FROM (SELECT k, {SENDER} AS s, subject, date_h FROM {FIRST} WHERE trim(subject) <> '' AND trim(date_h) <> '') GROUP BY s, subject, date_h HAVING count(*) > 1""")
def alias_copies(spark, at):
    m = messages(spark, at, "from_h", "subject", "date_h").filter((F.trim("subject") != "") & (F.trim("date_h") != ""))
    grouped = m.groupBy(sender_address("from_h").alias("s"), "subject", "date_h").agg(F.min("k").alias("kept"), F.count(F.lit(1)).alias("copies"))
    return grouped.filter("copies > 1").select("kept", "copies")


@query(f"""WITH b AS (SELECT max(batch_id) AS last FROM message_summary) SELECT DISTINCT {K} AS msg_id FROM message_summary, b WHERE batch_id > last - 5 AND {K} NOT IN (SELECT {K} FROM message_summary, b WHERE batch_id <= last - 5)""")
def ingest_new(spark, at):
    df = table(spark, at, "message_summary").select(canonical_id("msg_id").alias("msg_id"), "batch_id")
    last = df.agg(F.max("batch_id")).first()[0]
    return df.filter(F.col("batch_id") > last - 5).select("msg_id").distinct().join(df.filter(F.col("batch_id") <= last - 5).select("msg_id"), "msg_id", "left_anti")


@query(f"""SELECT k AS msg_id, count(DISTINCT h) AS versions FROM (SELECT {K} AS k, sha256(concat_ws(chr(1), coalesce(subject, ''), coalesce(date_h, ''), coalesce(thread_id, ''))) AS h FROM message_summary) GROUP BY k HAVING count(DISTINCT h) > 1""")
def content_changes(spark, at):
    df = table(spark, at, "message_summary")
    h = text.content_hash(F.concat_ws("\u0001", *(F.coalesce(c, F.lit("")) for c in ("subject", "date_h", "thread_id"))))
    return df.select(canonical_id("msg_id").alias("msg_id"), h.alias("h")).groupBy("msg_id").agg(F.count_distinct("h").alias("versions")).filter("versions > 1")


@query("""SELECT batch_id, delivered, new_added, delivered - new_added AS repeated FROM (SELECT l.batch_id, l.new_added, count(m.delivery_id) AS delivered FROM sync_log l LEFT JOIN message_summary m USING (batch_id) GROUP BY ALL)""")
def run_reconciliation(spark, at):
    n = table(spark, at, "message_summary").groupBy("batch_id").agg(F.count(F.lit(1)).alias("delivered"))
    joined = table(spark, at, "sync_log").join(n, "batch_id", "left").withColumn("delivered", F.coalesce("delivered", F.lit(0)))
    return joined.select("batch_id", "delivered", "new_added", (F.col("delivered") - F.col("new_added")).alias("repeated"))


@query("""SELECT batch_id, max(CASE WHEN status = 'ok' THEN epoch_us(run_at) END) OVER (ORDER BY run_at ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS since_us, epoch_us(run_at) AS until_us FROM sync_log""")
def run_watermarks(spark, at):
    runs = table(spark, at, "sync_log")
    before = W.Window.orderBy("run_at").rowsBetween(W.Window.unboundedPreceding, -1)  # one row a run
    return runs.select("batch_id", F.max(F.when(F.col("status") == "ok", F.unix_micros(F.col("run_at").cast("timestamp")))).over(before).alias("since_us"), F.unix_micros(F.col("run_at").cast("timestamp")).alias("until_us"))


@query("""SELECT status, count(*) AS runs, CAST(sum(scanned) AS BIGINT) AS scanned, CAST(sum(coalesce(new_added, 0)) AS BIGINT) AS new_added, CAST(sum(enriched) AS BIGINT) AS enriched, CAST(sum(failed) AS BIGINT) AS failed, count(*) FILTER (WHERE new_added IS NULL) AS broken FROM sync_log GROUP BY status""")
def run_stats(spark, at):
    s = table(spark, at, "sync_log").groupBy("status")
    total = lambda c: F.sum(F.coalesce(c, F.lit(0))).cast("long").alias(c)
    return s.agg(F.count(F.lit(1)).alias("runs"), total("scanned"), total("new_added"), total("enriched"), total("failed"), F.count_if(F.col("new_added").isNull()).alias("broken"))


@query("""WITH w AS (SELECT batch_id AS run, run_at AS s, lead(run_at) OVER (ORDER BY run_at) AS e FROM sync_log) SELECT w.run, count(*) AS deliveries FROM message_summary m JOIN w ON m.ingested_at >= w.s AND m.ingested_at < w.e GROUP BY w.run""")
def edition_windows(spark, at):
    runs = table(spark, at, "sync_log").select(F.col("batch_id").alias("run"), F.col("run_at").alias("s"), F.lead("run_at").over(W.Window.orderBy("run_at")).alias("e")).filter("e IS NOT NULL")
    found = timelines.in_windows(table(spark, at, "message_summary").select("ingested_at"), runs, "ingested_at", "s", "e")
    return found.groupBy("run").agg(F.count(F.lit(1)).alias("deliveries"))


@query(f"""WITH m AS (SELECT {SENDER} AS sender, CAST(ingested_at AT TIME ZONE 'UTC' AS DATE) AS d FROM message_summary), u AS (SELECT DISTINCT sender, d FROM m WHERE d IS NOT NULL), g AS (SELECT sender, d, date_diff('day', lag(d) OVER (PARTITION BY sender ORDER BY d), d) AS g FROM u)
    SELECT sender, count(*) AS arrivals, min(d) AS first_day, max(d) AS last_day, max(g) AS longest_gap, round(avg(g), 6) AS mean_gap FROM g GROUP BY sender""")  # fmt: skip
def inter_arrival(spark, at):
    return timelines.gaps(table(spark, at, "message_summary").select(sender_address("from_h").alias("sender"), "ingested_at"), "sender", F.to_date("ingested_at"))


@query(f"""WITH m AS (SELECT {SENDER} AS sender, CAST(ingested_at AT TIME ZONE 'UTC' AS DATE) AS d FROM message_summary), l AS (SELECT sender, count(DISTINCT d) AS n, min(d) AS first_day, max(d) AS last_day FROM m GROUP BY sender), z AS (SELECT max(d) AS today FROM m)
    SELECT sender, last_day, round(date_diff('day', first_day, last_day) / (n - 1), 6) AS cadence_days, date_diff('day', last_day, today) AS silent_days FROM l, z WHERE n >= 5 AND date_diff('day', last_day, today) > 3 * date_diff('day', first_day, last_day) / (n - 1)""")  # fmt: skip
def silence_alerts(spark, at):
    """Senders that have been silent for longer than three times their own cadence, the mean days between their arrivals."""
    m = table(spark, at, "message_summary").select(sender_address("from_h").alias("sender"), F.to_date("ingested_at").alias("d"))
    today = m.agg(F.max("d")).scalar()
    last = m.groupBy("sender").agg(F.count_distinct("d").alias("n"), F.min("d").alias("first_day"), F.max("d").alias("last_day")).filter("n >= 5")
    cadence = F.datediff("last_day", "first_day") / (F.col("n") - 1)
    return last.select("sender", "last_day", cadence.alias("c"), F.datediff(today, "last_day").cast("long").alias("silent_days")).filter("silent_days > 3 * c").withColumn("cadence_days", F.round("c", 6)).drop("c")


@query(rf"""SELECT count(*) AS messages, count(*) FILTER (WHERE contains(f.body, m.snippet) AND length(m.snippet) > 0) AS verified FROM full_message f JOIN {FIRST} m ON m.k = lower(f.msg_id)""")
def snippet_evidence(spark, at):
    m = messages(spark, at, "snippet").select(F.col("k").alias("msg_id"), "snippet")
    bodies = table(spark, at, "full_message").select(canonical_id("msg_id").alias("msg_id"), "body")
    found = checks.verified(m.join(bodies.select("msg_id"), "msg_id", "left_semi"), bodies, "msg_id", "snippet", "body")
    return found.agg(F.count(F.lit(1)).alias("messages"), F.count_if("verified").alias("verified"))


_DIVIDER = r"\n(?:\*\*\*|• • •|─{4,}|[\x{1F300}-\x{1FAFF}\x{2600}-\x{27BF}\x{FE0F} ]{1,12})\n"
_PARTS = rf"regexp_split_to_array(regexp_replace(replace(body, chr(13), ''), '\n(#{{1,6}} [^\n]+)', chr(10) || '***' || chr(10) || '\1', 'g'), '{_DIVIDER}')"


def parts_of(body):
    """The sections of a body: divided by rules, stars, dots and lines of emoji; a heading begins a section."""
    return F.split(F.regexp_replace(F.replace(body, F.lit("\r"), F.lit("")), r"\n(#{1,6} [^\n]+)", "\n***\n$1"), _DIVIDER)


@query(rf"""SELECT msg_id, CAST(count(*) AS BIGINT) AS sections, CAST(max(length(p)) AS BIGINT) AS longest FROM (SELECT msg_id, unnest({_PARTS}) AS p FROM full_message WHERE length(body) > 0) GROUP BY msg_id""")
def section_split(spark, at):
    m = table(spark, at, "full_message").filter(F.length("body") > 0).select("msg_id", F.posexplode(parts_of(F.col("body"))).alias("seq", "p"))
    return m.groupBy("msg_id").agg(F.count(F.lit(1)).alias("sections"), F.max(F.length("p")).cast("long").alias("longest"))


_SPONSOR = r"(?i)(^ad enquiries|sponsored|presented by|in partnership|advertisement|sales desk)"


@query(rf"""SELECT msg_id, count(*) AS lines, count(*) FILTER (WHERE regexp_matches(l, '{_SPONSOR}')) AS sponsored FROM (SELECT msg_id, unnest(string_split(body, chr(10))) AS l FROM full_message WHERE length(body) > 0) GROUP BY msg_id HAVING count(*) FILTER (WHERE regexp_matches(l, '{_SPONSOR}')) > 0""")
def sponsor_lines(spark, at):
    m = table(spark, at, "full_message").filter(F.length("body") > 0).select("msg_id", F.explode(F.split("body", "\n")).alias("l"))
    return m.groupBy("msg_id").agg(F.count(F.lit(1)).alias("lines"), F.count_if(F.col("l").rlike(_SPONSOR)).alias("sponsored")).filter("sponsored > 0")


@query(r"""SELECT msg_id, text_hash, words, round(words / 230, 6) AS minutes FROM (SELECT msg_id, sha256(b) AS text_hash, CAST(len(list_filter(regexp_split_to_array(b, '\s+'), lambda w: w <> '')) AS BIGINT) AS words FROM (SELECT msg_id, coalesce(body, '') AS b FROM full_message))""")
def word_counts(spark, at):
    m = table(spark, at, "full_message").select("msg_id", F.coalesce("body", F.lit("")).alias("b"))
    return m.select("msg_id", text.content_hash(F.col("b")).alias("text_hash"), text.word_count(F.col("b")).alias("words")).withColumn("minutes", F.round(text.reading_minutes(F.col("words")), 6))


def _any_sql(c: str, words: tuple[str, ...]) -> str:
    return "(" + " OR ".join(f"contains(lower({c}), '{w}')" for w in words) + ")"


_BODIES = f"(SELECT msg_id, body FROM full_message UNION ALL SELECT msg_id, body FROM {X.SIGNAL_PAGES.sql()})"


@query(f"""SELECT msg_id, {_any_sql('body', routing.ROBOT_TEST)} AS robot_test, list_min(list_filter([{', '.join(f"strpos(lower(body), '{w}')" for w in routing.PAYWALL)}], lambda x: x > 0)) AS paywall_cut_at
    FROM {_BODIES} WHERE {_any_sql('body', routing.ROBOT_TEST + routing.PAYWALL)}""")  # fmt: skip
def page_signals(spark, at):
    """Over all bodies and a few stated pages, as the tables hold neither a robot test nor a paywall."""
    m = table(spark, at, "full_message").select("msg_id", "body").unionByName(X.SIGNAL_PAGES.spark(spark)).filter(routing.signal(F.col("body"), routing.ROBOT_TEST + routing.PAYWALL))
    return m.select("msg_id", routing.signal(F.col("body"), routing.ROBOT_TEST).alias("robot_test"), routing.paywall_cut(F.col("body")).cast("long").alias("paywall_cut_at"))


@query(f"""WITH w AS (SELECT max(run_at) AS since FROM sync_log WHERE status = 'ok' AND batch_id <= (SELECT max(batch_id) - 5 FROM message_summary)), m AS (SELECT {K} AS msg_id, {SENDER} AS sender, ingested_at, batch_id FROM message_summary), z AS (SELECT max(batch_id) AS last FROM m),
    fresh AS (SELECT * FROM m, w, z WHERE ingested_at > since - INTERVAL 2 DAY AND batch_id > last - 5 AND sender IN (SELECT sender FROM m, z WHERE batch_id <= last - 5))
    SELECT msg_id, arg_min(sender, ingested_at) AS sender, epoch_us(min(ingested_at)) AS first_us FROM fresh WHERE msg_id NOT IN (SELECT msg_id FROM m, z WHERE batch_id <= last - 5) GROUP BY msg_id""")  # fmt: skip
def incremental_ingest(spark, at):
    m = table(spark, at, "message_summary").select(canonical_id("msg_id").alias("msg_id"), sender_address("from_h").alias("sender"), F.col("ingested_at").cast("timestamp").alias("ingested_at"), "batch_id")
    last = m.agg(F.max("batch_id")).first()[0] or 0
    roster = m.filter(F.col("batch_id") <= last - 5).select("sender")
    runs = table(spark, at, "sync_log").filter(F.col("batch_id") <= last - 5).withColumn("run_at", F.col("run_at").cast("timestamp"))
    new = ingest.incremental(m.filter(F.col("batch_id") > last - 5), roster, m.filter(F.col("batch_id") <= last - 5), "msg_id", "sender", "ingested_at", ingest.watermark(runs))
    return new.select("msg_id", "sender", F.unix_micros("ingested_at").alias("first_us"))


@query(rf"""SELECT regexp_extract(s, '@(.*)$', 1) AS host, count(*) AS messages, count(DISTINCT s) AS senders FROM (SELECT {SENDER} AS s FROM {FIRST}) GROUP BY 1""")
def sender_hosts(spark, at):
    m = messages(spark, at, "from_h").select(sender_address("from_h").alias("s"))
    return m.groupBy(F.regexp_extract("s", "@(.*)$", 1).alias("host")).agg(F.count(F.lit(1)).alias("messages"), F.count_distinct("s").alias("senders"))


@query(f"SELECT name, count(*) AS items, count(DISTINCT s) AS sources, max(p) AS top_pct, min(p) AS low_pct, count(DISTINCT s) = 1 AS single_source FROM (SELECT *, CASE WHEN {_DOWN_SQL} THEN -v ELSE v END AS p FROM {_MOVES}) GROUP BY name")
def hype_flags(spark, at):
    m = messages(spark, at, "from_h", "subject").filter(F.contains("subject", F.lit("%"))).select(sender_address("from_h").alias("s"), F.explode(text.movers(F.col("subject"))).alias("m")).select("s", "m.*")
    x = m.groupBy("name").agg(F.count(F.lit(1)).alias("items"), F.count_distinct("s").alias("sources"), F.max("pct").alias("top_pct"), F.min("pct").alias("low_pct"))
    return x.withColumn("single_source", F.col("sources") == 1)
