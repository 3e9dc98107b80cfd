"""Queries over documents, events, orders and stated inputs: coverage, similarity, facts, selection, windows, streams."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import window as W

from newsloom.functions import dates, html, text, urls
from newsloom.operators import checks, coverage, pairs, selection, timelines
from newsloom.plans import fixtures as X
from newsloom.plans.durable import durable, join_counted
from newsloom.sources import readers
from newsloom.sources.tables import table
from newsloom.streaming import windows

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLE[f.__name__] = sql
        return f

    return add


# ---- coverage of stories

_NORM = r"trim(regexp_replace(text, '\s+', ' ', 'g'))"
_MEMBERS = f"(SELECT sha256({_NORM}) AS cluster_id, doc_id, source FROM documents WHERE {_NORM} <> '')"
_CLUSTERS = f"(SELECT cluster_id, count(DISTINCT source) AS coverage_n, count(*) AS size, min(doc_id) AS first_id, list_sort(list(DISTINCT source) FILTER (WHERE source IS NOT NULL)) AS sources FROM {_MEMBERS} GROUP BY cluster_id)"
_ROSTER = "(SELECT row_number() OVER (ORDER BY source) AS roster_pos, source FROM (SELECT DISTINCT source FROM documents WHERE source IS NOT NULL))"


def _members(spark, at):
    return coverage.members(table(spark, at, "documents"), "doc_id", "source", "text")


@query(f"""SELECT cluster_id, coverage_n, size, first_id, array_to_string(sources, ',') AS sources, (SELECT count(*) FROM {_ROSTER}) AS roster_n FROM {_CLUSTERS} WHERE size > 1""")
def coverage_leaderboard(spark, at):
    roster_n = table(spark, at, "documents").agg(F.count_distinct("source")).scalar()
    c = coverage.coverage(_members(spark, at), "doc_id", "source").filter("size > 1")
    return c.select("cluster_id", "coverage_n", "size", "first_id", F.array_join("sources", ",").alias("sources"), roster_n.alias("roster_n"))


@query(f"""SELECT cluster_id, coverage_n, roster_n, array_to_string(list_transform(places, lambda p: CASE WHEN list_contains(sources, p) THEN '■' ELSE '□' END), '') AS strip
    FROM {_CLUSTERS}, (SELECT list(source ORDER BY roster_pos) AS places, count(*) AS roster_n FROM {_ROSTER}) WHERE coverage_n > 1""")  # fmt: skip
def coverage_strip(spark, at):
    c = coverage.coverage(_members(spark, at), "doc_id", "source").filter("coverage_n > 1")
    return coverage.strip(c, coverage.roster(table(spark, at, "documents"), "source"), "source").select("cluster_id", "coverage_n", "roster_n", "strip")


@query(f"SELECT roster_pos, source FROM {_ROSTER} WHERE source NOT IN (SELECT source FROM {_MEMBERS} JOIN {_CLUSTERS} USING (cluster_id) WHERE coverage_n >= 3 AND source IS NOT NULL)")
def roster_quiet(spark, at):
    m = durable(_members(spark, at))
    return coverage.quiet(coverage.roster(table(spark, at, "documents"), "source"), m, coverage.coverage(m, "doc_id", "source"), "source", 3)


@query(f"""SELECT cluster_id, first_id, coverage_n, rank FROM (SELECT *, row_number() OVER (ORDER BY coverage_n DESC, size DESC, cluster_id) AS rank FROM {_CLUSTERS}) WHERE rank <= 3""")
def lead_story(spark, at):
    c = coverage.coverage(_members(spark, at), "doc_id", "source")
    top = c.orderBy(F.desc("coverage_n"), F.desc("size"), "cluster_id").limit(3)
    return top.select("cluster_id", "first_id", "coverage_n", F.row_number().over(W.Window.orderBy(F.desc("coverage_n"), F.desc("size"), "cluster_id")).cast("long").alias("rank"))


_QUALITY = f"(SELECT source, count(*) FILTER (WHERE n >= 2) / count(*) AS quality FROM (SELECT source, count(DISTINCT source) OVER (PARTITION BY cluster_id) AS n FROM {_MEMBERS}) GROUP BY source)"
_SCORED = f"""(SELECT c.cluster_id, first_id, coverage_n, round(0.40 * coverage_n / roster_n + 0.25 * (coalesce(level * 2.0, 5.0) - 1) / 9 + 0.15 * greatest(0.0, least(1.0, 1 - age / 365.0)) + 0.10 * coalesce(quality, 0.0) + 0.10 * CASE WHEN sides >= 2 THEN 1.0 ELSE 0.0 END
    - CASE WHEN age > 365 THEN 0.1 ELSE 0.0 END - CASE WHEN previews AND coverage_n <= 1 THEN 0.1 ELSE 0.0 END, 6) AS score
    FROM {_CLUSTERS} c JOIN (SELECT cluster_id, avg(l.reading_level) AS level, avg(q.quality) AS quality, greatest(count(DISTINCT l.low), count(DISTINCT l.high), max(CASE WHEN l.low < l.high THEN 2 ELSE 0 END)) AS sides, bool_and(coalesce(d.content_shape = 'teaser', false)) AS previews, min(date_diff('day', d.issue_date, z.today)) AS age
    FROM {_MEMBERS} m JOIN documents d USING (doc_id) LEFT JOIN (SELECT doc_id, avg(reading_level) AS reading_level, min(reading_level) AS low, max(reading_level) AS high FROM reading_labels GROUP BY doc_id) l USING (doc_id) LEFT JOIN {_QUALITY} q ON q.source = m.source,
    (SELECT max(issue_date) AS today FROM documents) z GROUP BY cluster_id) USING (cluster_id), (SELECT count(*) AS roster_n FROM {_ROSTER}))"""  # fmt: skip


def _scored(spark, at):
    docs = table(spark, at, "documents")
    m = durable(_members(spark, at))
    cover = coverage.coverage(m, "doc_id", "source")
    labels = table(spark, at, "reading_labels").groupBy("doc_id").agg(F.avg("reading_level").alias("level"), F.min("reading_level").alias("low"), F.max("reading_level").alias("high"))
    # a source is as good as the share of its documents whose story others cover too
    quality = m.join(cover.select("cluster_id", "coverage_n"), "cluster_id").groupBy("source").agg((F.count_if(F.col("coverage_n") >= 2) / F.count(F.lit(1))).alias("quality"))
    each = m.join(docs.select("doc_id", "issue_date", "content_shape"), "doc_id").join(labels, "doc_id", "left").join(F.broadcast(quality), "source", "left")  # one row a source
    sides = F.greatest(F.count_distinct("low"), F.count_distinct("high"), F.max(F.when(F.col("low") < F.col("high"), 2).otherwise(0)).cast("long"))
    aged = each.groupBy("cluster_id").agg(F.avg("level").alias("level"), F.max("issue_date").alias("newest"), F.avg("quality").alias("quality"), sides.alias("sides"), F.bool_and(F.coalesce(F.col("content_shape") == "teaser", F.lit(False))).alias("previews"))
    today, roster_n = docs.agg(F.max("issue_date")).scalar(), docs.agg(F.count_distinct("source")).scalar()
    c = cover.join(aged, "cluster_id").withColumn("roster_n", roster_n).withColumn("age", F.datediff(today, "newest"))
    age = F.col("age")
    penalty = F.when(age > 365, 0.1).otherwise(0.0) + F.when(F.col("previews") & (F.col("coverage_n") <= 1), 0.1).otherwise(0.0)
    parts = {"coverage_norm": F.col("coverage_n") / F.col("roster_n"), "relevance": selection.relevance(F.col("level") * 2.0), "freshness": selection.freshness(age, 365), "source_quality": F.col("quality"), "split_bonus": F.when(F.col("sides") >= 2, 1.0).otherwise(0.0)}
    s = selection.score(penalty, **parts)
    return c.select("cluster_id", "first_id", "coverage_n", F.round(s, 6).alias("score"))


@query(f"SELECT * FROM {_SCORED}")
def score_rank(spark, at):
    return _scored(spark, at)


@query(f"""SELECT cluster_id, place, CASE WHEN place <= 1 THEN 'big_one' WHEN place <= 3 THEN 'split' WHEN place <= 4 THEN 'hype_check' ELSE 'quick_hit' END AS slot FROM (SELECT cluster_id, row_number() OVER (ORDER BY coverage_n DESC, score DESC, cluster_id) AS place FROM {_SCORED}) WHERE place <= 12""")
def slot_fill(spark, at):
    dealt = selection.slots(_scored(spark, at), [("big_one", 1), ("split", 2), ("hype_check", 1), ("quick_hit", 8)], [F.desc("coverage_n"), F.desc("score"), F.col("cluster_id")])
    return dealt.select("cluster_id", F.col("place").cast("long").alias("place"), "slot")


@query("SELECT content_shape, n, round(n / sum(n) OVER (), 6) AS share FROM (SELECT content_shape, count(*) AS n FROM documents GROUP BY content_shape)")
def share_of_total(spark, at):
    return selection.share(table(spark, at, "documents"), "content_shape")


@query("SELECT segment, lang, count(*) AS documents, CAST(sum(n_chars) AS BIGINT) AS n_chars, round(avg(n_chars), 6) AS mean_chars FROM documents GROUP BY segment, lang")
def segment_counts(spark, at):
    return table(spark, at, "documents").groupBy("segment", "lang").agg(F.count(F.lit(1)).alias("documents"), F.sum("n_chars").alias("n_chars"), F.round(F.avg("n_chars"), 6).alias("mean_chars"))


@query("SELECT segment, string_agg(CAST(doc_id AS VARCHAR), ',' ORDER BY rank) AS top3 FROM (SELECT segment, doc_id, row_number() OVER (PARTITION BY segment ORDER BY n_chars DESC, doc_id) AS rank FROM documents WHERE segment IS NOT NULL) WHERE rank <= 3 GROUP BY segment")
def top3_subject(spark, at):
    top = selection.top_per(table(spark, at, "documents").filter("segment IS NOT NULL").select("segment", "doc_id", "n_chars"), "segment", [F.desc("n_chars"), F.col("doc_id")], 3)
    return top.groupBy("segment").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("rank", "doc_id"))), lambda x: x["doc_id"].cast("string")), ",").alias("top3"))


@query("SELECT p_type, p_partkey, p_retailprice FROM (SELECT *, row_number() OVER (PARTITION BY p_type ORDER BY p_retailprice DESC, p_partkey) AS r FROM part) WHERE r = 1")
def best_module(spark, at):
    return selection.top_per(table(spark, at, "part").select("p_type", "p_partkey", "p_retailprice"), "p_type", [F.desc("p_retailprice"), F.col("p_partkey")]).drop("rank")


@query("SELECT issue_date, string_agg(DISTINCT segment, ',' ORDER BY segment) AS segments, count(*) AS items FROM documents WHERE issue_date IS NOT NULL GROUP BY issue_date")
def calendar_merge(spark, at):
    d = table(spark, at, "documents").filter("issue_date IS NOT NULL").groupBy("issue_date").agg(F.array_sort(F.collect_set("segment")).alias("s"), F.count(F.lit(1)).alias("items"))
    return d.select("issue_date", F.when(F.size("s") > 0, F.array_join("s", ",")).alias("segments"), "items")


@query("SELECT source, segment, row_number() OVER (PARTITION BY source, segment ORDER BY issue_date, doc_id) AS issue_no, doc_id FROM documents WHERE source IS NOT NULL AND issue_date IS NOT NULL")
def issue_numbers(spark, at):
    """A running number in every edition, that is source and segment; no segment is one, too."""
    d = table(spark, at, "documents").filter("source IS NOT NULL AND issue_date IS NOT NULL").select(F.struct("source", "segment").alias("edition"), "issue_date", "doc_id")
    return selection.numbered(d, "edition", "issue_date", "doc_id", "issue_no").select("edition.source", "edition.segment", "issue_no", "doc_id")


@query("SELECT doc_id, date_diff('day', issue_date, today) AS age, date_diff('day', issue_date, today) > 365 AS stale FROM documents, (SELECT max(issue_date) AS today FROM documents) WHERE issue_date IS NOT NULL")
def freshness(spark, at):
    d = table(spark, at, "documents").filter("issue_date IS NOT NULL").select("doc_id", "issue_date")
    today = d.agg(F.max("issue_date")).scalar()
    return d.select("doc_id", F.datediff(today, "issue_date").cast("long").alias("age")).withColumn("stale", F.col("age") > 365)


_ISSUE = ("segment", "source", "issue_date")


@query("""SELECT segment, source, issue_date, '{"segment":"' || segment || '","source":"' || source || '","issue_date":"' || issue_date || '","stories":[' || string_agg('{"doc_id":' || doc_id || ',"n_chars":' || n_chars || '}', ',' ORDER BY doc_id) || ']}' AS issue
    FROM documents WHERE segment IS NOT NULL AND source IS NOT NULL AND issue_date IS NOT NULL GROUP BY segment, source, issue_date""")  # fmt: skip
def issue_json(spark, at):
    """One nested document per issue, that is what one source brings in one segment on one day: never a whole segment in a row."""
    d = table(spark, at, "documents").filter("segment IS NOT NULL AND source IS NOT NULL AND issue_date IS NOT NULL").groupBy(*_ISSUE).agg(F.array_sort(F.collect_list(F.struct("doc_id", "n_chars"))).alias("stories"))
    return d.select(*_ISSUE, F.to_json(F.struct(*_ISSUE, "stories")).alias("issue"))


@query("SELECT source, count(*) AS labelled, round(avg(reading_level), 6) AS mean_level, count(*) FILTER (WHERE reading_level >= 4) AS demanding FROM documents JOIN reading_labels USING (doc_id) GROUP BY source")
def source_quality(spark, at):
    d = table(spark, at, "documents").select("doc_id", "source").join(table(spark, at, "reading_labels"), "doc_id")
    return d.groupBy("source").agg(F.count(F.lit(1)).alias("labelled"), F.round(F.avg("reading_level"), 6).alias("mean_level"), F.count_if(F.col("reading_level") >= 4).alias("demanding"))


@query("SELECT doc_id, count(*) AS claims, array_to_string(list_slice(list_sort(list(DISTINCT reading_level)), 1, 3), '|') AS sides FROM reading_labels WHERE reading_level IS NOT NULL GROUP BY doc_id HAVING count(*) >= 2 AND count(DISTINCT reading_level) >= 2")
def stance_split(spark, at):
    return checks.splits(table(spark, at, "reading_labels"), "doc_id", "reading_level").select("doc_id", "claims", F.array_join(F.transform("sides", lambda x: x.cast("string")), "|").alias("sides"))


@query("SELECT doc_id, k AS agreeing, n AS raters, round(k / n, 6) AS consensus FROM (SELECT doc_id, max(c) AS k, CAST(sum(c) AS BIGINT) AS n FROM (SELECT doc_id, reading_level, count(*) AS c FROM reading_labels GROUP BY ALL) GROUP BY doc_id)")
def consensus_meter(spark, at):
    c = table(spark, at, "reading_labels").groupBy("doc_id", "reading_level").agg(F.count(F.lit(1)).alias("c"))
    return c.groupBy("doc_id").agg(F.max("c").alias("agreeing"), F.sum("c").alias("raters")).withColumn("consensus", F.round(F.col("agreeing") / F.col("raters"), 6))


# ---- links, pages, texts

_URLS = r"""(SELECT doc_id, regexp_replace(u, '[.,;:!?)\]]+$', '') AS url FROM (SELECT doc_id, unnest(regexp_extract_all(text, '(https?://[^\s<>"]+)', 1)) AS u FROM documents))"""
_HOST = r"nullif(regexp_replace(lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/@?#]*@)?([^/:?#]+)', 1)), '^www\.', ''), '')"


@query(f"SELECT * FROM {_URLS}")
def link_extract(spark, at):
    return table(spark, at, "documents").select("doc_id", F.explode(urls.links(F.col("text"))).alias("url"))


@query(f"SELECT {_HOST} AS host, count(*) AS links, count(DISTINCT doc_id) AS documents FROM {_URLS} GROUP BY 1")
def url_domain_counts(spark, at):
    return link_extract(spark, at).groupBy(urls.host(F.col("url")).alias("host")).agg(F.count(F.lit(1)).alias("links"), F.count_distinct("doc_id").alias("documents"))


@query(rf"""WITH b AS (SELECT link_id, regexp_replace(trim(url), '#.*$', '') AS bare FROM {X.LINKS.sql()}), p AS (SELECT link_id, regexp_replace(string_split(bare, '?')[1], '/+$', '') AS head, list_sort(list_filter(string_split(CASE WHEN contains(bare, '?') THEN substring(bare, strpos(bare, '?') + 1) ELSE '' END, '&'),
    lambda x: x <> '' AND NOT regexp_matches(x, '^(?:utm_[^=]*|gclid|fbclid|mc_cid|mc_eid)(?:=|$)'))) AS kept FROM b), s AS (SELECT *, regexp_extract(head, '^([A-Za-z][A-Za-z0-9+.-]*://[^/]*)', 1) AS start FROM p)
    SELECT link_id, lower(start) || substring(head, length(start) + 1) || CASE WHEN len(kept) > 0 THEN '?' || array_to_string(kept, '&') ELSE '' END AS canonical FROM s""")  # fmt: skip
def url_canonicalize(spark, at):
    return X.LINKS.spark(spark).select("link_id", urls.canonical(F.col("url")).alias("canonical"))


@query(rf"""SELECT link_id, nullif(url_decode(regexp_extract(url, '[?&](?:url|u|q|target)=(https?(?:%3A|:)[^&#]+)', 1)), '') AS target, coalesce({_HOST} IN ('go.example') AND regexp_extract(url, '[?&](?:url|u|q|target)=(https?(?:%3A|:)[^&#]+)', 1) = '', false) AS is_tracking FROM {X.LINKS.sql()}""")
def redirect_unwrap(spark, at):
    return X.LINKS.spark(spark).select("link_id", urls.unwrapped(F.col("url")).alias("target"), urls.is_tracking(F.col("url"), ["go.example"]).alias("is_tracking"))


_HTML = f"(SELECT CAST(page_id AS VARCHAR) AS page_id, html FROM {X.PAGES.sql()} UNION ALL SELECT msg_id, html_body FROM full_message WHERE html_body IS NOT NULL)"


def _html(spark, at):
    """The HTML bodies and a few stated pages with blocks that they lack."""
    bodies = table(spark, at, "full_message").filter("html_body IS NOT NULL").select(F.col("msg_id").alias("page_id"), F.col("html_body").alias("html"))
    return X.PAGES.spark(spark).select(F.col("page_id").cast("string").alias("page_id"), "html").unionByName(bodies)


def _plain_sql(c: str) -> str:
    out = f"regexp_replace({c}, '<!--[\\s\\S]*?-->', ' ', 'g')"
    for tag in ("script", "style", "nav", "footer"):
        out = f"regexp_replace({out}, '(?is)<{tag}\\b[^>]*>.*?</{tag}\\s*>', ' ', 'g')"
    out = f"trim(regexp_replace(regexp_replace({out}, '<[^>]+>', ' ', 'g'), '\\s+', ' ', 'g'))"
    for a, b in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "''"), ("&nbsp;", " "), ("&amp;", "&")):
        out = f"replace({out}, '{a}', '{b}')"
    return out


@query(f"SELECT msg_id, sha256(t) AS text_hash, CAST(length(t) AS BIGINT) AS n_chars FROM (SELECT msg_id, {_plain_sql('html_body')} AS t FROM full_message WHERE html_body IS NOT NULL)")
def html_to_text(spark, at):
    m = table(spark, at, "full_message").filter("html_body IS NOT NULL").select("msg_id", html.plain_text(F.col("html_body")).alias("t"))
    return m.select("msg_id", text.content_hash(F.col("t")).alias("text_hash"), F.length("t").cast("long").alias("n_chars"))


@query(f"SELECT page_id, {_plain_sql(chr(39).join(['regexp_replace(html, ', '(?is)<div[^>]*class=[' + chr(34) + chr(92) + 'x27][^' + chr(34) + chr(92) + 'x27]*\\b(?:ad|sponsor|promo)\\b[^' + chr(34) + chr(92) + 'x27]*[' + chr(34) + chr(92) + 'x27][^>]*>.*?</div>', ', ', ' ', ', ', 'g', ')']))} AS plain FROM {_HTML}")
def ad_block_strip(spark, at):
    return _html(spark, at).select("page_id", html.plain_text(html.without_ads(F.col("html"))).alias("plain"))


@query(rf"""SELECT page_id, unnest(regexp_extract_all(html, '<a[^>]*href="([^"]*)"[^>]*>(.*?)</a>', 1)) AS href, unnest(regexp_extract_all(html, '<a[^>]*href="([^"]*)"[^>]*>(.*?)</a>', 2)) AS anchor FROM {_HTML}""")
def anchor_extract(spark, at):
    return _html(spark, at).select("page_id", F.explode(urls.anchors(F.col("html"))).alias("a")).select("page_id", "a.href", "a.anchor")


@query()
def html_markdown(spark, at):
    """Structure kept; SQL can't express it, see the tests."""
    return table(spark, at, "full_message").filter("html_body IS NOT NULL").select("msg_id", html.markdown(F.col("html_body")).alias("markdown"))


@query(rf"""SELECT item_id, array_to_string(regexp_extract_all(text, '\$([A-Z]{{1,5}})\b', 1), ',') AS tickers, array_to_string(regexp_extract_all(text, '({text.NUMBER})', 1), ' | ') AS numbers, trim(regexp_extract(text, '(?i)(?:why it matters|the bottom line): *([^\n]+)', 1)) AS take,
    TRY_CAST(regexp_extract(text, '(?i)\b(\d+) min(?:ute)? read\b', 1) AS BIGINT) AS minutes, coalesce(regexp_matches(text, '(?i)\bai\b'), false) AS about_ai FROM (SELECT 'i' || item_id AS item_id, text FROM {X.ITEMS.sql()} UNION ALL SELECT 'd' || doc_id, text FROM documents)""")  # fmt: skip
def item_grammar(spark, at):
    c = F.col("text")
    docs = table(spark, at, "documents").select(F.concat(F.lit("d"), "doc_id").alias("item_id"), "text")
    items = X.ITEMS.spark(spark).select(F.concat(F.lit("i"), "item_id").alias("item_id"), "text").unionByName(docs)
    return items.select("item_id", F.array_join(text.tickers(c), ",").alias("tickers"), F.array_join(text.numbers(c), " | ").alias("numbers"), text.signpost(c).alias("take"), text.read_label(c).alias("minutes"), F.coalesce(c.rlike(r"(?i)\bai\b"), F.lit(False)).alias("about_ai"))


@query(rf"""SELECT n, count(*) AS uses, count(DISTINCT doc_id) AS documents FROM (SELECT doc_id, unnest(regexp_extract_all(text, '({text.NUMBER})', 1)) AS n FROM documents) GROUP BY n""")
def number_extract(spark, at):
    d = table(spark, at, "documents").select("doc_id", F.explode(text.numbers(F.col("text"))).alias("n"))
    return d.groupBy("n").agg(F.count(F.lit(1)).alias("uses"), F.count_distinct("doc_id").alias("documents"))


# ---- similarity and groups

_HEADS = r"""(SELECT tokens, min(doc_id) AS class_id FROM (SELECT doc_id, list_sort(list_distinct(list_filter(regexp_split_to_array(lower(regexp_extract(text, '^\s*([^\n]*)', 1)), '[^\p{L}\p{N}]+'), lambda w: w <> ''))) AS tokens FROM documents) WHERE len(tokens) > 0 GROUP BY tokens)"""
_PAIRS = f"(SELECT a.class_id AS a, b.class_id AS b, len(list_intersect(a.tokens, b.tokens)) AS c, len(a.tokens) AS na, len(b.tokens) AS nb FROM {_HEADS} a JOIN {_HEADS} b ON a.class_id < b.class_id WHERE len(list_intersect(a.tokens, b.tokens)) * 10 >= 6 * (len(a.tokens) + len(b.tokens) - len(list_intersect(a.tokens, b.tokens))))"


def _heads(spark, at):
    d = table(spark, at, "documents").select("doc_id", F.regexp_extract("text", r"^\s*([^\n]*)", 1).alias("head"))
    return pairs.classes(d, "doc_id", "head")


@query(f"SELECT a, b, round(c / (na + nb - c), 6) AS similarity FROM {_PAIRS}")
def jaccard_pairs(spark, at):
    """Pairs between distinct headline sets; documents with equal sets are one class (see headline_classes)."""
    return pairs.jaccard_pairs(_heads(spark, at)[0], 0.6).withColumn("similarity", F.round("similarity", 6))


@query(f"""SELECT d.doc_id, h.class_id FROM {_HEADS} h JOIN (SELECT doc_id, list_sort(list_distinct(list_filter(regexp_split_to_array(lower(regexp_extract(text, '^\\s*([^\\n]*)', 1)), '[^\\p{{L}}\\p{{N}}]+'), lambda w: w <> ''))) AS tokens FROM documents) d USING (tokens)""")
def headline_classes(spark, at):
    return _heads(spark, at)[1]


@query(f"""WITH RECURSIVE e AS (SELECT a, b FROM {_PAIRS}), sym AS (SELECT a, b FROM e UNION SELECT b, a FROM e), r(node, seen) AS (SELECT a, a FROM sym UNION SELECT r.node, sym.b FROM r JOIN sym ON sym.a = r.seen) SELECT node, min(seen) AS component FROM r GROUP BY node""")
def cluster_components(spark, at):
    return pairs.components(pairs.jaccard_pairs(_heads(spark, at)[0], 0.6))


@query(r"""WITH e AS (SELECT DISTINCT doc_id, w AS entity FROM (SELECT doc_id, unnest(regexp_extract_all(text, '\p{L}+')) AS w FROM documents) WHERE regexp_full_match(w, '[A-Z][a-z]{4,}'))
    SELECT a, doc_id AS b, entity FROM (SELECT doc_id, entity, min(doc_id) OVER (PARTITION BY entity) AS a FROM e) WHERE doc_id > a""")  # fmt: skip
def entity_links(spark, at):
    """Documents that share an entity: each entity of the whole text, once a document, linked to its first document."""
    found = F.array_distinct(F.regexp_extract_all("text", F.lit(r"(?<!\p{L})([A-Z][a-z]{4,})(?!\p{L})"), F.lit(1)))
    return pairs.star_edges(durable(table(spark, at, "documents").select("doc_id", F.explode(found).alias("entity"))), "doc_id", "entity")


@query("""SELECT q.vec_id AS query_id, r.vec_id, round(list_cosine_similarity(CAST(q.embedding AS DOUBLE[]), CAST(r.embedding AS DOUBLE[])), 4) AS cosine FROM embeddings q JOIN embeddings r ON q.vec_id <> r.vec_id WHERE q.vec_id % 100 = 0 AND list_cosine_similarity(CAST(q.embedding AS DOUBLE[]), CAST(r.embedding AS DOUBLE[])) >= 0.3""")
def cosine_neighbours(spark, at):
    """The stated query set is every vector whose id is divisible by 100, against all vectors."""
    e = table(spark, at, "embeddings").select("vec_id", "embedding")
    return pairs.cosine_neighbours(e, e.filter("vec_id % 100 = 0"), 0.3).withColumn("cosine", F.round("cosine", 4))


@query(f"""WITH RECURSIVE e AS (SELECT a, b FROM {_PAIRS}), sym AS (SELECT a, b FROM e UNION SELECT b, a FROM e), r(node, seen) AS (SELECT a, a FROM sym UNION SELECT r.node, sym.b FROM r JOIN sym ON sym.a = r.seen), g AS (SELECT node, min(seen) AS component FROM r GROUP BY node),
    c AS (SELECT d.doc_id, d.source, coalesce(g.component, h.class_id) AS story FROM {_HEADS} h JOIN (SELECT doc_id, source, list_sort(list_distinct(list_filter(regexp_split_to_array(lower(regexp_extract(text, '^\\s*([^\\n]*)', 1)), '[^\\p{{L}}\\p{{N}}]+'), lambda w: w <> ''))) AS tokens FROM documents) d USING (tokens) LEFT JOIN g ON g.node = h.class_id)
    SELECT story, count(*) AS documents, count(DISTINCT source) AS coverage_n FROM c GROUP BY story""")  # fmt: skip
def story_coverage(spark, at):
    """Coverage of stories as groups of near headlines: equal ones are a class, near classes a component."""
    sets, members = _heads(spark, at)
    linked = pairs.components(pairs.jaccard_pairs(sets, 0.6)).select(F.col("node").alias("class_id"), "component")
    m = durable(members.join(table(spark, at, "documents").select("doc_id", "source"), "doc_id"))
    per = durable(m.groupBy("class_id").agg(F.count(F.lit(1)).alias("n")).join(linked, "class_id", "left").select("class_id", "n", F.coalesce("component", "class_id").alias("story")))
    named = join_counted(m, per, "class_id", "n", per.agg(F.sum("n")).first()[0] or 0)
    return named.groupBy("story").agg(F.count(F.lit(1)).alias("documents"), F.count_distinct("source").alias("coverage_n"))


# ---- facts

@query("""SELECT l_partkey, count(*) AS sources, min(v) AS lowest, max(v) AS highest FROM (SELECT l_partkey, l_suppkey, min(l_extendedprice / l_quantity) AS v FROM lineitem GROUP BY ALL) GROUP BY l_partkey HAVING count(*) > 1 AND max(v) > min(v) AND (max(v) - min(v)) / abs(min(v)) > 0.05""")
def conflict_facts(spark, at):
    l = table(spark, at, "lineitem").select("l_partkey", "l_suppkey", (F.col("l_extendedprice") / F.col("l_quantity")).alias("v"))
    return checks.conflicts(l, "l_partkey", "l_suppkey", "v", 0.05).select("l_partkey", "sources", "lowest", "highest")


@query("""SELECT n_name, count(*) AS lines, count(DISTINCT o_orderkey) AS orders, count(DISTINCT c_custkey) AS customers, round(sum(l_extendedprice * (1 - l_discount)), 2) AS revenue FROM nation JOIN supplier ON s_nationkey = n_nationkey JOIN lineitem ON l_suppkey = s_suppkey JOIN orders ON o_orderkey = l_orderkey JOIN customer ON c_custkey = o_custkey GROUP BY n_name""")
def trace_lineage(spark, at):
    t = lambda n: table(spark, at, n)
    chain = t("lineitem").join(t("supplier").join(t("nation"), F.col("s_nationkey") == F.col("n_nationkey")), F.col("l_suppkey") == F.col("s_suppkey"))
    chain = chain.join(t("orders"), F.col("o_orderkey") == F.col("l_orderkey")).join(t("customer"), F.col("c_custkey") == F.col("o_custkey"))
    return chain.groupBy("n_name").agg(F.count(F.lit(1)).alias("lines"), F.count_distinct("o_orderkey").alias("orders"), F.count_distinct("c_custkey").alias("customers"), F.round(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))), 2).alias("revenue"))


_VALUE = "TRY_CAST(replace(regexp_extract({0}, '(\\d[\\d,]*(?:\\.\\d+)?)', 1), ',', '') AS DOUBLE) * CASE regexp_extract({0}, '\\d ?([KMBT])\\b', 1) WHEN 'K' THEN 1e3 WHEN 'M' THEN 1e6 WHEN 'B' THEN 1e9 WHEN 'T' THEN 1e12 ELSE 1 END"
_UNIT = "CASE WHEN contains({0}, '%') THEN '%' WHEN contains({0}, 'bps') THEN 'bps' WHEN starts_with({0}, '$') THEN '$' WHEN starts_with({0}, '€') THEN '€' WHEN starts_with({0}, '£') THEN '£' ELSE '' END"


@query(rf"""WITH used AS (SELECT story, unnest(regexp_extract_all(text, '({text.NUMBER})', 1)) AS number FROM {X.COPY.sql()}), known AS (SELECT story, {_VALUE.format("value")} AS v, {_UNIT.format("value")} AS unit FROM {X.FACTS.sql()})
    SELECT story, number FROM used u WHERE NOT EXISTS (SELECT 1 FROM known k WHERE k.story = u.story AND k.v = {_VALUE.format("number")} AND k.unit = {_UNIT.format("number")})""")  # fmt: skip
def validate_numbers(spark, at):
    return checks.unknown_numbers(X.COPY.spark(spark), X.FACTS.spark(spark), "story", "text")


@query(rf"""SELECT story, quote, reason FROM (SELECT q.story, quote, CASE WHEN len(list_filter(regexp_split_to_array(quote, '\s+'), lambda w: w <> '')) >= 15 THEN 'long' WHEN NOT coalesce(contains(c.text, quote), false) THEN 'not verbatim' WHEN count(*) OVER (PARTITION BY q.story) > 1 THEN 'several' END AS reason
    FROM {X.QUOTES.sql()} q LEFT JOIN {X.COPY.sql()} c USING (story)) WHERE reason IS NOT NULL""")  # fmt: skip
def validate_quotes(spark, at):
    return checks.bad_quotes(X.QUOTES.spark(spark), X.COPY.spark(spark), "story")


EXTRACTION = "tldr string, tone string, importance int, topics array<string>, entities array<struct<name string, entity_type string, mention_count int>>"


@query(f"""SELECT msg_id, e.name AS name, e.entity_type AS entity_type, CAST(e.mention_count AS BIGINT) AS mentions FROM (SELECT msg_id, unnest(from_json(payload -> 'entities', '[{{"name": "VARCHAR", "entity_type": "VARCHAR", "mention_count": "INTEGER"}}]')) AS e FROM {X.EXTRACTIONS.sql()} WHERE json_valid(payload) AND json_type(payload, '$.entities') = 'ARRAY')""")
def json_fanout(spark, at):
    parsed = X.EXTRACTIONS.spark(spark).select("msg_id", F.from_json("payload", EXTRACTION).alias("x"))
    return parsed.select("msg_id", F.explode("x.entities").alias("e")).select("msg_id", "e.name", "e.entity_type", F.col("e.mention_count").cast("long").alias("mentions"))


@query(f"SELECT msg_id, CASE WHEN NOT coalesce(json_valid(payload), false) THEN 'broken' WHEN json_extract_string(payload, '$.tldr') IS NOT NULL AND json_type(payload, '$.topics') = 'ARRAY' AND json_type(payload, '$.entities') = 'ARRAY' THEN 'valid' ELSE 'missing' END AS state FROM {X.EXTRACTIONS.sql()}")
def json_validity(spark, at):
    x = X.EXTRACTIONS.spark(spark).select("msg_id", F.from_json("payload", EXTRACTION + ", _bad string", {"columnNameOfCorruptRecord": "_bad"}).alias("x"), "payload")
    full = F.col("x.tldr").isNotNull() & F.col("x.topics").isNotNull() & F.col("x.entities").isNotNull()
    return x.select("msg_id", F.when((F.col("payload") == "") | F.col("x").isNull() | F.col("x._bad").isNotNull(), "broken").when(full, "valid").otherwise("missing").alias("state"))


@query("SELECT CAST(json_extract(props, '$.k') AS BIGINT) AS k, event_type, count(*) AS n FROM events GROUP BY ALL")
def event_props(spark, at):
    e = table(spark, at, "events").select(F.from_json("props", "k bigint").getField("k").alias("k"), "event_type")
    return e.groupBy("k", "event_type").agg(F.count(F.lit(1)).alias("n"))


# ---- stated inputs

_STAMP = r"regexp_extract(line, '^\s*(\d{2}:\d{2}:\d{2}[.,]\d{3}) *-->', 1)"


@query(rf"""WITH l AS (SELECT *, {_STAMP} AS stamp, trim(regexp_replace(line, '<[^>]+>', '', 'g')) AS text FROM {X.CUES.sql()}), c AS (SELECT *, count(nullif(stamp, '')) OVER (PARTITION BY video_id ORDER BY line_no) AS cue FROM l),
    s AS (SELECT *, max(nullif(stamp, '')) OVER (PARTITION BY video_id, cue) AS began FROM c), f AS (SELECT video_id, cue, any_value(began) AS began, arg_min(text, line_no) AS text FROM s WHERE cue > 0 AND stamp = '' AND text <> '' AND NOT regexp_matches(line, '^\s*\d+\s*$') GROUP BY video_id, cue),
    k AS (SELECT *, lag(text) OVER (PARTITION BY video_id ORDER BY cue) AS was FROM f)
    SELECT video_id, row_number() OVER (PARTITION BY video_id ORDER BY cue) AS cue_no, CAST(substring(began, 1, 2) AS DOUBLE) * 3600 + CAST(substring(began, 4, 2) AS DOUBLE) * 60 + CAST(substring(began, 7, 2) AS DOUBLE) + CAST(substring(began, 10, 3) AS DOUBLE) / 1000 AS start, text FROM k WHERE text IS DISTINCT FROM was""")  # fmt: skip
def cue_dedup(spark, at):
    return readers.cues(X.CUES.spark(spark))


@query(f"SELECT name, row_number() OVER (ORDER BY list_transform(string_split(version, '.'), lambda x: CAST(x AS INT)) DESC, name) AS place FROM {X.VERSIONS.sql()}")
def version_sort(spark, at):
    v = X.VERSIONS.spark(spark).withColumn("v", F.transform(F.split("version", r"\."), lambda x: x.cast("int")))
    return selection.placed(v.select("name", "v"), [F.desc("v"), F.col("name")], "place").drop("v")


@query(rf"""SELECT n, CASE WHEN length(p) > 140 THEN rtrim(substring(p, 1, 140)) || '…' ELSE p END AS line FROM (SELECT n, regexp_replace(trim(prompt, ' '), '\s+', ' ', 'g') AS p FROM {X.PROMPTS.sql()}) WHERE p <> '' AND NOT starts_with(p, '<') AND NOT contains(lower(p), 'system-reminder') AND NOT starts_with(p, '[Request interrupted') AND NOT starts_with(lower(p), 'caveat:')""")
def prompt_lines(spark, at):
    p = X.PROMPTS.spark(spark).select("n", text.summary_line(F.col("prompt")).alias("line"))
    low = F.lower("line")
    noise = F.startswith("line", F.lit("<")) | F.contains(low, F.lit("system-reminder")) | F.startswith("line", F.lit("[Request interrupted")) | F.startswith(low, F.lit("caveat:"))
    return p.filter((F.col("line") != "") & ~noise)


@query(f"SELECT edition, day, epoch_us(CAST(day || ' 07:30:00 America/New_York' AS TIMESTAMPTZ)) AS start_us, dayofweek(CAST(day AS DATE)) = 5 AS friday FROM {X.EDITIONS.sql()}")
def edition_times(spark, at):
    d = F.to_date("day")
    return X.EDITIONS.spark(spark).select("edition", "day", F.unix_micros(dates.edition_instant(d, "07:30")).alias("start_us"), dates.is_friday(d).alias("friday"))


@query("SELECT doc_id, sha256(replace(replace(rtrim(to_base64(encode(text)), '='), '+', '-'), '/', '_')) AS encoded, sha256(text) AS decoded, sha256('\"' || replace(regexp_replace(text, '\\r?\\n', ' ', 'g'), '\"', '\"\"') || '\"') AS cell FROM documents WHERE length(text) > 0")
def base64url_round_trip(spark, at):
    """Hashes of each whole text encoded, of what comes back, and of it as a cell."""
    d = table(spark, at, "documents").filter(F.length("text") > 0)
    encoded = text.to_base64url(F.col("text"))
    return d.select("doc_id", *(text.content_hash(c).alias(n) for n, c in (("encoded", encoded), ("decoded", text.from_base64url(encoded)), ("cell", text.csv_cell(F.col("text"))))))


# ---- events: batch and streams

@query("SELECT user_id, count(*) FILTER (WHERE event_type = 'view') AS view, count(*) FILTER (WHERE event_type = 'click') AS click, count(*) FILTER (WHERE event_type = 'purchase') AS purchase FROM events WHERE event_type IN ('view', 'click', 'purchase') GROUP BY user_id")
def feedback_pivot(spark, at):
    p = table(spark, at, "events").filter(F.col("event_type").isin("view", "click", "purchase")).groupBy("user_id").pivot("event_type", ["view", "click", "purchase"]).count()
    return p.fillna(0, ["view", "click", "purchase"])


@query("""SELECT p.event_id, v.value AS seen, epoch_us(v.ts) AS seen_us FROM (SELECT * FROM events WHERE event_type = 'purchase') p ASOF LEFT JOIN (SELECT user_id, ts, max(value) AS value FROM events WHERE event_type = 'view' GROUP BY ALL) v ON p.user_id = v.user_id AND p.ts >= v.ts""")
def arrival_asof(spark, at):
    e = table(spark, at, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    bought = e.filter("event_type = 'purchase'").select("event_id", "user_id", "ts")
    viewed = e.filter("event_type = 'view'").select("user_id", "ts", F.col("value").alias("seen"))
    return timelines.as_of(bought, viewed, "user_id", "ts", "seen").select("event_id", "seen", F.unix_micros("seen_ts").alias("seen_us"))


@query("""SELECT count(*) AS n, event_type FROM events, (SELECT max(ts) AS now FROM events) WHERE ts > now - INTERVAL 1 DAY OR (ts > now - INTERVAL 7 DAY AND event_type = 'signup' AND ts <= now - INTERVAL 1 DAY) GROUP BY event_type""")
def weeklies_window(spark, at):
    e = table(spark, at, "events")
    aged = e.withColumn("now", e.agg(F.max("ts")).scalar())
    last_run = aged.filter("ts > now - INTERVAL 1 DAY")
    weeklies = aged.filter("ts > now - INTERVAL 7 DAY AND event_type = 'signup' AND ts <= now - INTERVAL 1 DAY")
    return last_run.unionByName(weeklies).groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))


@query("""SELECT kind, count(*) AS items, count(DISTINCT source) AS sources FROM (SELECT 'newsletter' AS kind, source FROM documents UNION ALL SELECT 'web', event_type FROM events) GROUP BY kind""")
def web_union(spark, at):
    letters = table(spark, at, "documents").select(F.lit("newsletter").alias("kind"), "doc_id", "source")
    web = table(spark, at, "events").select(F.lit("web").alias("kind"), F.col("event_type").alias("source"), "ts")
    return letters.unionByName(web, allowMissingColumns=True).groupBy("kind").agg(F.count(F.lit(1)).alias("items"), F.count_distinct("source").alias("sources"))


@query("""SELECT event_type, epoch_us(w) AS start_us, count(*) AS n FROM (SELECT event_type, unnest([time_bucket(INTERVAL 12 HOUR, ts), time_bucket(INTERVAL 12 HOUR, ts) - INTERVAL 12 HOUR]) AS w FROM events) GROUP BY ALL""")
def entity_timeline(spark, at):
    e = table(spark, at, "events").groupBy("event_type", F.window("ts", "24 hours", "12 hours").alias("w")).agg(F.count(F.lit(1)).alias("n"))
    return e.select("event_type", F.unix_micros(F.col("w.start").cast("timestamp")).alias("start_us"), "n")


def _stream(spark, at):
    return windows.stream(spark, f"{at}/events.parquet")


def _us(df):
    return df.withColumn("start_us", F.unix_micros("start")).drop("start", "end")


_CLOSED = "(SELECT time_bucket(INTERVAL 1 MILLISECOND, max(ts)) - INTERVAL 1 HOUR AS mark FROM events)"


@query(f"""SELECT event_type, epoch_us(w) AS start_us, n, total FROM (SELECT event_type, time_bucket(INTERVAL 1 HOUR, ts) AS w, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY ALL), {_CLOSED} WHERE w + INTERVAL 1 HOUR <= mark""")
def stream_tumbling(spark, at):
    """Windows that the watermark has closed; open ones come with a later run."""
    return _us(windows.drained(windows.tumbling(_stream(spark, at), "ts", "event_type", "1 hour"))).withColumn("total", F.round("total", 4))


@query(f"""SELECT event_type, epoch_us(w) AS start_us, n FROM (SELECT event_type, w, count(*) AS n FROM (SELECT event_type, unnest([time_bucket(INTERVAL 12 HOUR, ts), time_bucket(INTERVAL 12 HOUR, ts) - INTERVAL 12 HOUR]) AS w FROM events) GROUP BY ALL), {_CLOSED} WHERE w + INTERVAL 24 HOUR <= mark""")
def stream_sliding(spark, at):
    return _us(windows.drained(windows.tumbling(_stream(spark, at), "ts", "event_type", "24 hours", slide="12 hours"))).drop("total")


@query(f"""SELECT user_id, start_us, n FROM (SELECT user_id, epoch_us(min(ts)) AS start_us, max(ts) AS last, count(*) AS n FROM (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS s FROM (SELECT *, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) < INTERVAL 2 HOUR THEN 0 ELSE 1 END AS new FROM events)) GROUP BY user_id, s), {_CLOSED} WHERE last + INTERVAL 2 HOUR <= mark""")
def stream_session(spark, at):
    return _us(windows.drained(windows.sessions(_stream(spark, at), "ts", "user_id", "2 hours")))


@query("""SELECT count(*) AS kept, count(DISTINCT user_id) AS users FROM (SELECT DISTINCT user_id, event_type FROM events)""")
def stream_dedup(spark, at):
    e = windows.deduplicated(_stream(spark, at), "ts", ["user_id", "event_type"], "60 days")
    return windows.drained(e.select("user_id", "event_type")).agg(F.count(F.lit(1)).alias("kept"), F.count_distinct("user_id").alias("users"))


BANNED = ["revolutionary", "game-changing", "guaranteed", "unbelievable"]


@query(rf"""SELECT line_id, trim(regexp_extract(line, '^\W*([^,:]+?)(?:,| raised| raises)', 1)) AS company, trim(regexp_extract(line, ', an? ([^,]+?)-based', 1)) AS place, trim(regexp_extract(line, '(?i)rais(?:ed|es) ([$€£]\d[\d.,]* ?(?:[KMBT]|million|billion)?)', 1)) AS amount,
    trim(regexp_extract(line, '(?i)\b((?:pre-)?seed|series [a-z])\b', 1)) AS round, trim(regexp_extract(line, '(?i)led by ([^.,;]+)', 1)) AS lead, TRY_CAST(replace(regexp_extract(line, '(?:★|⭐|stars:?) ?(\d[\d,]*)', 1), ',', '') AS BIGINT) AS stars,
    trim(regexp_extract(line, '(?i)(?:participation (?:from|by)|joined by|participants:) ([^.;]+)', 1)) AS participants, regexp_extract(line, '^\s*({text.EMOJI})', 1) AS sector, trim(regexp_extract(line, '\n\s*(?:\.\.\.|…) *([^\n]+)', 1)) AS subhead, regexp_extract(line, '(?i)(?:read more|full story|continue reading)[^\n]{{0,40}}?(https?://[^\s<>"]+)', 1) AS more,
    TRY_CAST(regexp_extract(line, '^\s*(\d{{4}}-\d{{2}}-\d{{2}}):', 1) AS DATE) AS day, array_to_string(list_filter(list_transform(string_split(regexp_replace(line, '^[^:]{{1,20}}: *', ''), '·'), lambda x: trim(x)), lambda x: x <> ''), ' | ') AS items, trim(regexp_extract(line, '(?is)(?:in this issue|in today.s issue|what''s inside|table of contents):?[ \t]*\n(.*?)(?:\n[ \t]*\n|$)', 1)) AS contents,
    regexp_matches(line, '(?i)(?:^|[^\p{{L}}])(?:{'|'.join(BANNED)})(?:[^\p{{L}}]|$)') AS banned FROM {X.LINES.sql()}""")  # fmt: skip
def structured_lines(spark, at):
    c = F.col("line")
    x = X.LINES.spark(spark).select("line_id", text.deal(c).alias("d"), text.repo(c).getField("stars").alias("stars"), F.array_join(text.calendar_items(c), " | ").alias("items"), text.contents(c).alias("contents"), text.holds_any(c, BANNED).alias("banned"), text.item_parts(c).alias("p"), text.calendar_day(c).alias("day"))
    return x.select("line_id", "d.*", "p.*", "day", "stars", "items", "contents", "banned")


#: Capitalised words of any script, less those that begin a line or sentence.
_CAPITALISED = r"(?m)(?<!\p{L})(?<!(?:^|[.!?…])[\s\"“”„‘’'()*•–-]{0,4})(\p{Lu}\p{Ll}{3,})(?!\p{L})"
_INNER = r"""regexp_replace(text, '(?:^|[\n.!?…])[\s"“”„‘’''()*•–-]{0,4}\p{L}*', chr(10), 'g')"""


@query(rf"""SELECT entity, count(*) AS documents, CAST(sum(n) AS BIGINT) AS mentions FROM (SELECT doc_id, entity, count(*) AS n FROM (SELECT doc_id, unnest(regexp_extract_all({_INNER}, '\p{{L}}+')) AS entity FROM documents) WHERE regexp_full_match(entity, '\p{{Lu}}\p{{Ll}}{{3,}}') GROUP BY doc_id, entity) GROUP BY entity""")
def entity_mentions(spark, at):
    """Names by a general rule: capitalised words within a sentence. German nouns count too; names that only begin lines don't."""
    d = table(spark, at, "documents").select("doc_id", F.explode(F.regexp_extract_all("text", F.lit(_CAPITALISED), F.lit(1))).alias("entity"))
    per = d.groupBy("doc_id", "entity").agg(F.count(F.lit(1)).alias("n"))
    return per.groupBy("entity").agg(F.count(F.lit(1)).alias("documents"), F.sum("n").alias("mentions"))


@query("""SELECT doc_id, words, round(words / 230, 6) AS minutes, bytes, bytes < 102 * 1024 AS fits FROM (SELECT doc_id, CAST(len(list_filter(regexp_split_to_array(text, '\\s+'), lambda w: w <> '')) AS BIGINT) AS words, CAST(octet_length(encode(text)) AS BIGINT) AS bytes FROM documents WHERE text IS NOT NULL)""")
def copy_limits(spark, at):
    d = table(spark, at, "documents").filter("text IS NOT NULL").select("doc_id", text.word_count(F.col("text")).alias("words"), F.octet_length("text").cast("long").alias("bytes"))
    return d.select("doc_id", "words", F.round(text.reading_minutes(F.col("words")), 6).alias("minutes"), "bytes", (F.col("bytes") < 102 * 1024).alias("fits"))
