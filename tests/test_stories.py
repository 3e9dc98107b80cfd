"""Checks of stories, searches, stages, sinks and seams: stated cases with nulls, ties, empty tables and hot keys."""

import datetime
import json

import pytest
from pyspark.sql import functions as F

from newsloom.functions import html, search, text
from newsloom.operators import deliveries, routing, selection, stories
from newsloom.plans import durable, stages
from newsloom.sources import readers, sinks
from newsloom.streaming import windows


def test_conflicts_by_unit(spark):
    rows = [("c", "Acme", "$", "a", 81.0), ("c", "Acme", "$", "b", 110.0), ("c", "Acme", "$", "b", 120.0), ("c", "Acme", "%", "a", 1.0), ("c", "Acme", "%", "b", 1.0), ("d", "Zed", "", "a", 1.0), ("d", "Zed", "", "a", 9.0), ("e", "X", "", None, 1.0), ("e", "X", "", "a", None)]
    df = spark.createDataFrame(rows, "cluster string, entity string, unit string, source string, v double")
    got = stories.conflicts_by_unit(df, ("cluster", "entity", "unit"), "source", "v").collect()
    assert [(r.cluster, r.entity, r.unit, r.sources, r.values_by_source) for r in got] == [("c", "Acme", "$", 2, {"a": 81.0, "b": 110.0})]
    assert stories.conflicts_by_unit(df.limit(0), ("cluster",), "source", "v").count() == 0


def test_story_errors(spark):
    rows = [(1, 2, 3, 0, 0, 0, []), (2, 0, 0, 1, 0, 0, None), (3, 1, 1, 0, 1, 1, ["reported"]), (4, 1, 1, 0, 0, 0, ["reported", "sources_differ"]), (5, None, None, None, None, None, None)]
    df = spark.createDataFrame(rows, "k int, sources int, facts int, sponsored_facts int, conflicts int, vendor_claims int, badges array<string>")
    got = {}
    for r in stories.story_errors(df, "k").collect():
        got.setdefault(r.k, set()).add(r.error)
    assert got == {2: {"no source", "no fact", "sponsored fact"}, 3: {"conflict without sources_differ", "vendor claim without self_reported"}, 4: {"sources_differ without conflict"}, 5: {"no source", "no fact"}}
    mended = df.withColumn("badges", stories.badges())
    assert {r.error for r in stories.story_errors(mended.filter("k IN (1, 3, 4)"), "k").collect()} == set()


def test_differences_and_archives(spark):
    a, b = spark.createDataFrame([(1, "x"), (1, "x"), (2, None)], "k int, t string"), spark.createDataFrame([("x", 1), (None, 2), ("z", 3)], "t string, k int")
    assert {r.side: r.rows for r in stories.differences(a, b).collect()} == {"first only": 1, "second only": 1}
    assert {(r.k, r.error) for r in stories.archive_errors(a.distinct(), b.withColumn("t", F.when(F.col("k") == 2, "new").otherwise(F.col("t"))), "k", "t").collect()} == {(2, "changed"), (3, "new")}


def test_retries(spark):
    rows = [("a", 1, "failed"), ("a", 2, "ok"), ("b", 1, "failed"), ("c", 1, "failed"), ("c", 2, "failed"), ("c", 3, "failed"), ("d", 1, None)]
    got = {r.k: (r.attempts, r.state) for r in stories.retry_queue(spark.createDataFrame(rows, "k string, at int, status string"), "k", "at", "status").collect()}
    assert got == {"a": (2, "done"), "b": (1, "retry"), "c": (3, "given up"), "d": (1, "retry")}


def test_seams(spark):
    s = spark.createDataFrame([(1, "a 5%")], "k int, section string")
    cards = stories.extracted(s, {"whole": lambda d: d.select("k", F.col("section").alias("headline")), "none": lambda d: d.filter("false").select("k", F.lit(1).alias("extra"))})
    assert [(r.k, r.headline, r.extra, r.extractor) for r in cards.collect()] == [(1, "a 5%", None, "whole")]
    with pytest.raises(ValueError):
        stories.extracted(s, {})
    p = spark.createDataFrame([(1, 0.9, 0), (2, 0.7, 2), (3, 0.7, None)], "a int, similarity double, common int")
    assert [(r.verdict, r.reason) for r in stories.judged(p).orderBy("a").collect()] == [("same", "headlines"), ("same", "entities"), ("different", "neither")]
    assert stories.judged(p, lambda d: d.withColumn("verdict", F.lit("model"))).first().verdict == "model"


def test_searches(spark):
    now = F.lit("2025-02-01 00:00:00").cast("timestamp")
    rows = [(1, "2025-01-31 12:00:00", "Ann <a@x.example>", "Chips and rates", "s", ["L"]), (2, "2024-12-01 00:00:00", None, None, "a big deal", None), (3, None, "b@y.example", "Big deal", None, [])]
    df = spark.createDataFrame(rows, "id int, t string, from_h string, subject string, snippet string, label_ids array<string>").withColumn("ts", F.to_timestamp("t")).withColumn("to_h", F.lit(None).cast("string"))
    found = lambda q: {r.id for r in df.filter(search.predicate(q, now)).collect()}
    assert found("in:anywhere") == {1, 2, 3} and found("newer_than:5d") == {1} and found("older_than:1m") == {2} and found("newer_than:36h -from:ann") == set()
    assert found('"big deal"') == {2, 3} and found("-subject:big") == {1, 2} and found("label:L") == {1} and found("-label:L") == {2, 3} and found("after:2025/01/01 before:2025/02/01") == {1}
    for bad in ("newer_than:x", "nobody:x", "in:spam"):
        with pytest.raises(ValueError):
            search.predicate(bad, now)


def test_options_and_templates(spark):
    df = spark.createDataFrame([(["--a=1=2", "--b", "x", "--a=3", "--c="],), ([],), (None,)], "args array<string>")
    assert [r.o for r in df.select(search.options(F.col("args")).alias("o")).collect()] == [{"a": "3", "b": "true", "c": ""}, {}, None]
    assert spark.range(1).select(search.filled(F.lit("{{a}} {{b}} {{c}}"), {"a": F.lit(1), "b": F.lit(None).cast("string")}).alias("x")).first().x == "1  {{c}}"


def test_rosters_and_senders(spark):
    m = spark.createDataFrame([(i, "Hot <a+x@b.example>") for i in range(300)] + [(900, None), (901, "z@b.example"), (902, "a@b.example")], "id int, f string")
    roster = spark.createDataFrame([(1, "a@b.example", None), (2, "a@b.example", "x"), (3, "b.example", None), (4, None, None)], "source_id bigint, sender_match string, alias_match string")
    got = {r.id: r.source_id for r in routing.sources_of(m, roster, "f").collect()}
    assert got[0] == 2 and got[900] is None and got[901] == 3 and got[902] == 1 and len(got) == 303
    rules = spark.createDataFrame([(2, "b.example", "B"), (1, "a+x@", "A")], "rank int, value string, segment string")
    by = {r.id: r.by_sender for r in routing.by_sender(m, rules, "f").collect()}
    assert by[5] == "A" and by[900] is None and by[901] == "B"
    assert routing.by_sender(m.limit(0), rules, "f").count() == 0 and routing.without_own(m, "f", ("A+X@",)).count() == 3


def test_alias_groups_and_places(spark):
    df = spark.createDataFrame([("b", "<1>", "s"), ("a", "<1>", "t"), ("c", None, None), ("d", " ", ""), ("e", None, "u")], "k string, m string, c string")
    assert sorted((r.kept, r.copies) for r in deliveries.alias_groups(df, "k", "m", "c").collect()) == [("a", 2), ("c", 2), ("e", 1)]
    placed = selection.placed(spark.range(1000).repartition(7), [F.desc("id")], "place").collect()
    assert {r.place: r.id for r in placed} == {i + 1: 999 - i for i in range(1000)}


def test_stages_go_on_where_they_failed(spark, tmp_path):
    ran = []

    def step(name, f):
        def go(df):
            ran.append(name)
            return f(df)

        return name, go

    def fails(_):
        raise RuntimeError("no")

    base, first = f"file://{tmp_path}/run", step("one", lambda _: spark.range(3))
    with pytest.raises(RuntimeError):
        stages.run(spark, [first, step("two", fails)], base)
    second, third = step("two", lambda d: d.filter("id > 0")), step("three", lambda d: d.selectExpr("sum(id) AS s"))
    assert stages.run(spark, [first, second, third], base).first().s == 3 and ran == ["one", "two", "two", "three"]
    assert stages.run(spark, [first, second, third], base, from_stage="three").first().s == 3 and ran[4:] == ["three"]
    with pytest.raises(ValueError):
        stages.run(spark, [first], base, from_stage="none")


def test_published_versions(spark, tmp_path):
    at = f"file://{tmp_path}/t"
    sinks.publish(spark.range(3).toDF("id"), at)
    sinks.publish(sinks.current(spark, at).filter("id > 0"), at)
    assert sinks.current(spark, at).count() == 2


def test_json_arrays_and_blobs(spark, tmp_path):
    df = spark.createDataFrame([(1, "a\"b"), (2, None)], "id int, t string")
    for d, n in ((df, 2), (df.limit(0), 0)):
        sinks.write_json_array(d, str(tmp_path / "j"))
        assert len(json.loads("".join(r.value for r in spark.read.text(str(tmp_path / "j")).collect()))) == n
    blobs = spark.createDataFrame([("s/a.eml", b"one"), ("s/b.eml", b""), ("c.eml", None)], "path string, raw binary")
    assert sorted((r.path, r.length) for r in sinks.write_blobs(blobs, str(tmp_path / "b")).collect()) == [("s/a.eml", 3), ("s/b.eml", 0)]
    assert (tmp_path / "b" / "s" / "a.eml").read_bytes() == b"one"
    with pytest.raises(Exception, match="not below"):
        sinks.write_blobs(blobs.withColumn("path", F.lit("../x")), str(tmp_path / "b"))
    box = readers.mailbox(spark, str(tmp_path / "b" / "s"), page=1, stop=1)
    assert box.count() == 1 and readers.mail_ids(spark, str(tmp_path / "b")).count() == 1  # a file without a byte holds no message
    (tmp_path / "b" / "s" / "h.eml").write_bytes(b"A: 1\r\nB: 2\r\n\r\nbody")
    assert [bytes(r.raw) for r in readers.mailbox(spark, str(tmp_path / "b" / "s"), headers_only=True).filter("msg_id = 'h'").collect()] == [b"A: 1\r\nB: 2\r\n"]
    assert readers.mailbox(spark, str(tmp_path / "b" / "s")).filter("msg_id = '../c'").count() == 0


def test_messages_with_their_children(spark, tmp_path):
    base = f"file://{tmp_path}/m"
    batch, links = spark.createDataFrame([("a", 1), ("b", 2), ("a", 3)], "msg_id string, n int"), spark.createDataFrame([("a", "x"), ("a", "y"), ("b", "z"), ("q", "none")], "msg_id string, url string")
    links.filter("msg_id = 'b'").write.parquet(f"{base}/links")  # a run that ended between children and message
    assert sinks.append_messages(batch, {"links": links}, base, "msg_id") == 2 and sinks.append_messages(batch, {"links": links}, base, "msg_id") == 0
    assert spark.read.parquet(f"{base}/links").count() == 3 and spark.read.parquet(f"{base}/messages").count() == 2


def test_silences_by_event_time(spark, tmp_path):
    rows = [("a", "2025-01-01 00:00:00"), ("a", "2025-01-01 01:00:00"), ("a", "2025-01-05 00:00:00"), ("b", "2025-01-08 00:00:00")]
    spark.createDataFrame(rows, "k string, t string").select("k", F.to_timestamp("t").alias("ts")).write.parquet(str(tmp_path / "in"))
    got = windows.drained(windows.silence_stream(windows.stream(spark, str(tmp_path / "in")), "ts", "k", "2 days")).collect()
    assert sorted((r.k, r.last_ts, r.events) for r in got) == [("a", datetime.datetime(2025, 1, 1, 1), 2), ("a", datetime.datetime(2025, 1, 5), 1)]


def test_markdown_blocks_and_styles(spark):
    md = "# T\n\n> quoted\n\n| a | b |\n|---|:-:|\n| 1 | **2** |\n\n```py\nx < 1\n```\n---\n- one"
    out = html.html_of(md)
    assert "<table><tr><th>a</th><th>b</th></tr><tr><td>1</td><td><strong>2</strong></td></tr></table>" in out and "<pre><code>x &lt; 1</code></pre>" in out and "<hr>" in out and "<blockquote>quoted</blockquote>" in out
    df = spark.createDataFrame([(md,), (None,), ("",)], "m string")
    rows = df.select(html.from_markdown(F.col("m"), {"h1": "color: red"}).alias("h"), html.markdown_title(F.col("m")).alias("t")).collect()
    assert rows[0].h.startswith('<h1 style="color: red">T</h1>') and [r.t for r in rows] == ["T", None, "Report"] and rows[1].h is None and rows[2].h == ""


def test_no_hot_key_reaches_one_task(spark):
    """A third of the rows has one identifier: after the counted anti join no partition holds them."""
    df = spark.range(30_000).select(F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 9000)).alias("msg_id"), F.col("id").alias("delivery_id"))
    counts = df.groupBy("msg_id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    for how in ("inner", "left_anti"):
        plan = durable.join_counted(df, counts, "msg_id", "n", 30_000, how)
        assert plan.count() == (30_000 - df.join(counts, "msg_id", "left_anti").count() if how == "inner" else df.join(counts, "msg_id", "left_anti").count())
    cold = df.join(counts.filter(f"n > {durable.hot_threshold(30_000)}").select("msg_id"), "msg_id", "left_anti")
    assert cold.groupBy("msg_id").count().agg(F.max("count")).first()[0] <= durable.hot_threshold(30_000)


def test_platforms_and_links(spark):
    assert spark.range(1).select(text.link_state(F.lit(None).cast("int"), F.lit(1)).alias("x")).first().x == "unchecked"
    assert spark.range(1).select(text.filled_emails(F.lit(None).cast("string")).alias("x")).first().x == []


@pytest.mark.parametrize(
    ("text_", "want"),
    [
        ('{"a": 1}', {"a": 1}), ('```json\n{"a": [1, 2,], }\n```', {"a": [1, 2]}), ('Sure: {"a": {"b": "x, }"}} done', {"a": {"b": "x, }"}}), ('{"a": [{"b": "cu', {"a": [{"b": "cu"}]}), ('{"a": 1, "b":', {"a": 1, "b": None}), ('{"a": 1, "b', {"a": 1}), ('{"a": 1,', {"a": 1}),
        ('{"q": "say \\\\"hi\\\\""', {"q": 'say "hi"'}), ("none", None), ("", None), (None, None), ("{]", None),
    ],
)
def test_json_repair(text_, want):
    from newsloom.functions import jsons

    fixed = jsons.repaired(text_.replace("\\\\", "\\") if text_ else text_)
    assert (None if fixed is None else json.loads(fixed)) == want


def test_json_repair_column(spark):
    from newsloom.functions import jsons

    df = spark.createDataFrame([(1, '{"a": 1}'), (2, '{"a": [1,'), (3, None), (4, "")], "k int, t string")
    assert {r.k: r.f for r in df.select("k", jsons.repair(F.col("t")).alias("f")).collect()} == {1: '{"a": 1}', 2: '{"a": [1]}', 3: None, 4: None}


def test_artifacts(spark):
    from newsloom.operators import issues

    df = spark.createDataFrame([("A", 2, "Two & more", None), ("A", 1, "One", "x"), ("B", 3, None, "y")], "edition string, k int, h string, s string")
    got = {(r.edition, r.kind): r.content for r in issues.artifacts(df, ("edition",), "k", "h", "s", spark.createDataFrame([(3, "no headline")], "k int, error string")).collect()}
    assert len(got) == 10 and got["A", "txt"] == "A\nOne\nTwo & more" and got["A", "html"] == "<h1>A</h1>\n<ul>\n<li>One</li>\n<li>Two &amp; more</li>\n</ul>"
    assert got["A", "validation.md"] == "no errors" and got["B", "validation.md"] == "- 3: no headline" and got["A", "trace.md"] == "- 1 < x\n- 2 < ?"
    assert json.loads(got["A", "json"])["stories"][0] == {"k": 1, "headline": "One", "source": "x"} and issues.artifacts(df.limit(0), ("edition",), "k", "h", "s").count() == 0
