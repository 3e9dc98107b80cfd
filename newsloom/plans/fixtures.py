"""Small stated inputs for patterns that the tables lack, the same for Spark and for SQL."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


def _sql(v: object) -> str:
    if v is None:
        return "NULL"
    if isinstance(v, bool):
        return str(v).upper()
    if isinstance(v, (int, float)):
        return str(v)
    if isinstance(v, (list, tuple)):
        return "[" + ", ".join(map(_sql, v)) + "]"
    return "'" + str(v).replace("'", "''") + "'"


SQL_TYPES = {"string": "VARCHAR", "bigint": "BIGINT"}


@dataclass(frozen=True)
class Fixture:
    schema: str
    rows: list[tuple]

    @property
    def names(self) -> list[str]:
        return [c.split()[0] for c in self.schema.split(", ")]

    def spark(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(self.rows, self.schema)

    def sql(self) -> str:
        """A table expression with the same rows."""
        cast = ", ".join(f"CAST({n} AS {SQL_TYPES[t]}) AS {n}" for n, t in (c.split() for c in self.schema.split(", ")))
        return f"(SELECT {cast} FROM (VALUES {', '.join('(' + ', '.join(map(_sql, r)) + ')' for r in self.rows)}) AS v({', '.join(self.names)}))"


RAW_MAIL = Fixture(
    "msg_id string, raw string",
    [
        ("m1", "From: \"Ann\" <A@News.example>\nTo: box+techai@mail.example\nSubject: Chips,\n  cuts\nDate: Mon, 06 Jan 2025 21:33:52 +0200\n\nbody"),
        ("m2", "from: Rates <daily@brew.example>\nDelivered-To: box@mail.example\nSUBJECT:\nDate: Tue, 07 Jan 2025 10:00:00 +0000\n\nSubject: not a header"),
        ("m3", "From: z@other.example\nSubject: no blank line"),
        ("m4", ""),
    ],
)
SENDER_ROUTES = Fixture(
    "rank bigint, value string, segment string",
    [(1, "hello@saffronabacus.example", "4-HRPeopleOps"), (2, "saffronabacus.example", "2-BizFinance"), (3, "jundolonews.example", "3-Legal"), (4, "rassonix.example", "7-Absurdist"), (5, "mailhop.example", "9-MainstreamNews"), (6, "", "none")],
)
ROSTER = Fixture(
    "source_id bigint, sender_match string, alias_match string",
    [(1, "em1014@mailhop.example", None), (2, "mailhop.example", None), (3, "saffronabacus.example", ""), (4, "code@wenkeviknews.example", "w"), (5, "code@wenkeviknews.example", None), (6, "letterloft.example", None), (7, None, None), (8, "", None)],
)
ALIAS_MAIL = Fixture(
    "msg_id string, message_id string, sender string, subject string, sent string",
    [
        ("a1", "<1@x.example>", "ann@x.example", "Chips", "2025-01-06"), ("a2", "<1@x.example>", "ann+w@x.example", "Fwd: Chips", "2025-01-07"), ("a3", None, "bob@y.example", "Rates", "2025-01-06"), ("a4", "", "bob@y.example", "Rates", "2025-01-06"),
        ("a5", None, "bob@y.example", "Rates", "2025-01-08"), ("a6", None, None, None, None), ("a7", None, None, None, None), ("a8", "<2@x.example>", "bob@y.example", "Rates", "2025-01-06"),
    ],
)
AUTH_MAIL = Fixture(
    "msg_id string, raw string",
    [
        ("h1", "DKIM-Signature: v=1; a=rsa-sha256; d=quillpost.example; s=k1\nSubject: One\nsubject: lower\nReceived-SPF: pass (domain of bounce@hop.example)\n\nbody"), ("h2", "ARC-Authentication-Results: i=1; mx.example; spf=pass smtp.mailfrom=letterloft.example\nsubject: only lower\n\nx"),
        ("h3", "Received-SPF: pass (mx: domain of news@corp.example designates) client-ip=1\nSubject:\n\nx"), ("h4", "Subject: none\n\nDKIM-Signature: d=body.example"), ("h5", ""), ("h6", None),
    ],
)
NAMED_SEGMENTS = Fixture("segment string, subscribe_email string", [("1-TechAI", "box+techai@inbox.example"), ("90-Blank", " "), ("91-Null", None), (None, "x@inbox.example")])
CLI_ARGS = Fixture("n bigint, line string", [(1, "--to=a@x.example --dry-run --where=a=b list"), (2, "plain"), (3, "--k=1 --k=2 --empty="), (4, ""), (5, None)])
MODULES = Fixture(
    "module_id bigint, type string, payload string",
    [(1, "number", '{"value": 81.5, "unit": "%"}'), (2, "mover", '{"name": "Acme", "pct": -3.5}'), (3, "repo", '{"name": "a/b", "stars": 120}'), (4, "mover", "broken"), (5, "mover", '{"name": "Zed"}'), (6, "quote", None)],
)
ATTENDEES = Fixture("event_id bigint, attendees string", [(1, '[{"email": "a@x.example"}, {"email": ""}, {"name": "no mail"}]'), (2, "[]"), (3, None), (4, "broken")])
CARD_EVIDENCE = Fixture(
    "fact_id bigint, evidence string, section string",
    [
        (1, "rose 12% to $81B", "Output rose 12% to $81B in May."), (2, "Rose  12%", "Output rose 12% to $81B in May."), (3, "“calm” markets", 'A day of "calm" markets'), (4, "never said", "Something else"), (5, "", "x"), (6, None, "x"), (7, "word " * 26, "word " * 40), (8, "said", None),
    ],
)
STATUSES = Fixture("link_id bigint, http_status bigint, checked_ms bigint", [(1, 200, 120), (2, 301, 4000), (3, 404, 90), (4, 200, 9000), (5, None, None), (6, 500, 10), (7, 399, 5000)])
TOKENS = Fixture("token string, issued string", [("a", "2025-01-01"), ("b", "2025-01-05"), ("c", None), ("d", "2025-01-07")])
FULL_EXTRACTIONS = Fixture(
    "msg_id string, payload string",
    [
        ("m1", '{"claims": [{"claim_text": "rates fall", "claim_type": "prediction"}], "quotes": [{"quote_text": "we wait", "speaker": "Ann"}], "links": [{"url": "https://a.example"}, {"url": "https://b.example"}], "entities": [{"name": "Acme"}], "stats": [{"value": "12", "unit": "%"}], "topics": [{"topic": "rates"}, {"topic": "chips"}]}'),
        ("m2", '{"claims": [], "links": null, "topics": [{"topic": "law"}]}'), ("m3", '{"claims": [{"cut'), ("m4", ""), ("m5", None),
    ],
)
SIGNAL_PAGES = Fixture(
    "msg_id string, body string",
    [("p1", "Please solve this reCAPTCHA to go on"), ("p2", "The week in chips. Upgrade to read on; become a member."), ("p3", "Bot check, then subscribe to read"), ("p4", "nothing of the kind"), ("p5", None)],
)
RULES = Fixture(
    "rule_id string, field string, value string, label string",
    [
        ("t1", "to", "readerbox+techai@inbox.example", "Newsletters/1-TechAI"), ("t2", "to", "readerbox+biz@inbox.example", "Newsletters/2-BizFinance"), ("s1", "from", "quillpost.example", "Platform/Quill"), ("s2", "from", "letterloft.example", "Platform/Loft"),
        ("s3", "from", "hello@saffronabacus.example", "Newsletters/4-HRPeopleOps"), ("s4", "from", "saffronabacus", "Big"), ("s5", "from", "policy@", "Policy"),
    ],
)
LINKS = Fixture(
    "link_id bigint, url string",
    [
        (1, "https://News.Example/a/?utm_source=x&id=2&b=1#top"), (2, "https://news.example/a?b=1&id=2"), (3, "http://m.example/p/?utm_medium=mail"), (4, "https://go.example/r?url=https%3A%2F%2Fnews.example%2Fa%3Fid%3D2&t=9"), (5, "https://go.example/x8Kq"), (6, "https://www.deep.example"), (7, "mailto:a@b.example"), (8, "https://go.example/r?u=https://plain.example/z&k=1"), (9, None), (10, ""),
    ],
)
PAGES = Fixture(
    "page_id bigint, html string",
    [
        (1, '<html><head><style>p {color: red}</style></head><body><nav>menu</nav><h1>Title</h1><p>One &amp; two</p><div class="ad">Buy <b>now</b></div><a href="https://a.example/x">read</a><script>var a = 1;</script><footer>bye</footer></body></html>'),
        (2, '<p>Pixel <img src="t.gif" width="1" height="1"> here</p><!-- hidden --><a class="k" href="https://b.example/?utm_source=m">B</a> <a href="/c">C <i>d</i></a>'),
        (3, "plain"), (4, ""), (5, None),
    ],
)
ITEMS = Fixture(
    "item_id bigint, text string",
    [
        (1, "Acme raises $12M in a Series A. Why it matters: chips are scarce\nThe bottom line: watch margins"), (2, "$AAPL rose 3.5% while $MSFT fell 120 bps on $1,200.50"), (3, "€81B vs €110B at the big AI lab"), (4, "He said wait (7 MINUTE READ)"), (5, "no amounts here, aim higher"), (6, None), (7, ""), (8, "$TOOLONG is none, £3K is"),
    ],
)
CUES = Fixture(
    "video_id string, line_no bigint, line string",
    [
        ("v", 0, "WEBVTT"), ("v", 1, ""), ("v", 2, "1"), ("v", 3, "00:00:01.000 --> 00:00:02.000"), ("v", 4, "<c>Hello</c> there"), ("v", 5, "second line"), ("v", 6, ""), ("v", 7, "2"), ("v", 8, "00:00:02.500 --> 00:00:03.000"), ("v", 9, "Hello there"),
        ("v", 10, "3"), ("v", 11, "01:00:03.250 --> 01:00:04.000"), ("v", 12, "Bye"), ("w", 1, "00:00:05.000 --> 00:00:06.000"), ("w", 2, "Bye"),
    ],
)
EXTRACTIONS = Fixture(
    "msg_id string, payload string",
    [
        ("m1", '{"tldr": "t", "tone": "calm", "importance": 3, "topics": ["ai", "chips"], "entities": [{"name": "Acme", "entity_type": "company", "mention_count": 2}, {"name": "Ann", "entity_type": "person", "mention_count": 1}]}'),
        ("m2", '{"tldr": null, "topics": [], "entities": []}'), ("m3", '{"tldr": "cut'), ("m4", ""), ("m5", '{"tldr": "u", "importance": 5, "topics": ["law"]}'),
    ],
)
COPY = Fixture("story string, text string", [("s1", "Output rose 12% to $81B"), ("s2", "A rise of 7% and $110B"), ("s3", "quiet")])
FACTS = Fixture("story string, value string", [("s1", "12%"), ("s1", "$81B"), ("s2", "7 bps"), ("s2", "$110,000M")])
QUOTES = Fixture("story string, quote string", [("s1", "rose 12%"), ("s2", "we never said this"), ("s3", "quiet"), ("s3", "qui")])
VERSIONS = Fixture("name string, version string", [("a", "1.2.10"), ("b", "1.10"), ("c", "1.2.9"), ("d", "2"), ("e", "1.2")])
PROMPTS = Fixture("n bigint, prompt string", [(1, "  fix   the\nparser "), (2, "<system> note"), (3, "[Request interrupted by user]"), (4, "x" * 200), (5, ""), (6, None)])
EDITIONS = Fixture("edition string, day string", [("tech", "2025-03-07"), ("tech", "2025-03-10"), ("finance", "2025-11-03"), ("finance", "2025-07-04")])
LINES = Fixture(
    "line_id bigint, line string",
    [
        (1, "Acme, a Berlin-based maker of chips, raised $12M in Series A funding led by Zed Capital."), (2, "owner/name.js ★ 1,234 – fast"), (3, "Tue: CPI · Fed minutes · "), (4, "Intro\nIn this issue:\n- one\n- two\n\nBody"), (5, "guaranteed gains, a revolutionary tool"), (6, ""), (7, None),
        (8, "🧬 Zed raised €3.5B in Series C funding led by Amber Fund with participation from Calix, Orbel; done"), (9, "Chips are back\n… and dearer than before\nRead more: https://a.example/x?y=1"), (10, "2025-01-09: CPI · Fed minutes"), (11, "2025-13-09: no day"),
    ],
)
