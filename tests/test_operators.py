"""Operators of the mail pipeline against brute force and stated cases, with nulls, ties and empty tables."""

import itertools
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from newsloom.functions.text import edit_similarity
from newsloom.operators import checks, coverage, pairs, routing, selection, timelines
from newsloom.plans import fixtures as X
from newsloom.streaming import windows


def test_coverage(spark):
    rows = [(1, "a", "x  y"), (2, "b", "x y "), (3, "b", "x y"), (4, "c", "z"), (5, None, "x y"), (6, "c", None), (7, "c", " ")]
    df = spark.createDataFrame(rows, "doc_id int, source string, text string")
    m = coverage.members(df, "doc_id", "source", "text")
    c = {r.first_id: r for r in coverage.coverage(m, "doc_id", "source").collect()}
    assert (c[1].coverage_n, c[1].size, c[1].sources) == (2, 4, ["a", "b"]) and c[4].coverage_n == 1 and m.count() == 5
    places = coverage.roster(df, "source")
    s = coverage.strip(coverage.coverage(m, "doc_id", "source"), places, "source").filter("first_id = 1").first()
    assert s.strip == "■■□" and s.roster_n == 3
    assert [r.source for r in coverage.quiet(places, m, coverage.coverage(m, "doc_id", "source"), "source").collect()] == ["c"]
    assert coverage.coverage(coverage.members(df.limit(0), "doc_id", "source", "text"), "doc_id", "source").count() == 0


def test_jaccard_pairs_lose_nothing(spark):
    r = random.Random(7)
    words = [f"w{i}" for i in range(14)]
    docs = [(i, " ".join(r.choices(words, k=r.randrange(1, 7)))) for i in range(220)] + [(900, None), (901, ""), (902, "..")]
    classes, members = pairs.classes(spark.createDataFrame(docs, "id int, t string"), "id", "t")
    sets = {row.class_id: set(row.tokens) for row in classes.collect()}
    assert {r.id for r in members.collect()} == set(range(220)) and len({frozenset(s) for s in sets.values()}) == len(sets)
    for t in (0.5, 0.6, 0.8, 1.0):
        want = {(a, b) for a, b in itertools.combinations(sorted(sets), 2) if len(sets[a] & sets[b]) / len(sets[a] | sets[b]) >= t - 1e-9}
        assert {(x.a, x.b) for x in pairs.jaccard_pairs(classes, t).collect()} == want


def test_components(spark, monkeypatch):
    r = random.Random(3)
    edges = [(r.randrange(60), r.randrange(60)) for _ in range(45)] + [(i, i + 1) for i in range(100, 140)] + [(200, 200)] + [(300, i) for i in range(301, 340)]
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a != b:
            parent[max(root(a), root(b))] = min(root(a), root(b))
    got = {x.node: x.component for x in pairs.components(spark.createDataFrame(edges, "a int, b int")).collect()}
    assert got == {x: root(x) for x in {y for e in edges if e[0] != e[1] for y in e}}
    monkeypatch.setattr(pairs, "BROADCAST_ROWS", 0)  # the way of large graphs
    assert got == {x.node: x.component for x in pairs.components(spark.createDataFrame(edges, "a int, b int")).collect()}
    assert pairs.components(spark.createDataFrame([], "a int, b int")).count() == 0


def test_star_edges_and_vectors(spark):
    df = spark.createDataFrame([(3, "x"), (1, "x"), (2, "x"), (4, "y"), (5, None)], "id int, v string")
    assert sorted((r.a, r.b) for r in pairs.star_edges(df, "id", "v").collect()) == [(1, 2), (1, 3)]
    v = spark.createDataFrame([(0, [1.0, 0.0]), (100, [1.0, 1.0]), (2, [0.0, 2.0]), (3, [0.0, 0.0]), (4, None)], "vec_id int, embedding array<float>")
    got = sorted((r.query_id, r.vec_id, round(r.cosine, 3)) for r in pairs.cosine_neighbours(v, v.filter("vec_id % 100 = 0"), 0.5).collect())
    assert got == [(0, 100, 0.707), (100, 0, 0.707), (100, 2, 0.707)]
    assert pairs.cosine_neighbours(v, v.limit(0), 0.5).count() == 0


def test_as_of(spark):
    r = random.Random(9)
    left = [(i, r.choice("abc"), r.randrange(0, 400_000)) for i in range(200)] + [(900, None, 5), (901, "a", None)]
    right = [(r.choice("ab"), r.randrange(0, 400_000), i) for i in range(150)] + [("a", 7, 1000), ("a", 7, 999), ("a", None, 5)]
    cast = lambda df: df.withColumn("ts", F.timestamp_seconds("s")).drop("s")
    got = {x.id: x.v for x in timelines.as_of(cast(spark.createDataFrame(left, "id int, k string, s int")), cast(spark.createDataFrame(right, "k string, s int, v int")), "k", "ts", "v").collect()}
    for i, k, s in left:
        hits = [(t, v) for kk, t, v in right if kk == k and t is not None and s is not None and t <= s]
        assert got[i] == (max(hits)[1] if hits else None)


def test_windows_and_gaps(spark):
    rows = spark.createDataFrame([(i, f"2025-01-0{d} 12:00:00") for i, d in enumerate([1, 2, 2, 5, 9])], "id int, t string").withColumn("t", F.to_timestamp("t"))
    runs = spark.createDataFrame([(1, "2025-01-01 12:00:00", "2025-01-02 12:00:00"), (2, "2025-01-02 12:00:00", "2025-01-08 00:00:00")], "run int, s string, e string").select("run", F.to_timestamp("s").alias("s"), F.to_timestamp("e").alias("e"))
    assert sorted((x.run, x.id) for x in timelines.in_windows(rows, runs, "t", "s", "e").collect()) == [(1, 0), (2, 1), (2, 2), (2, 3)]
    g = timelines.gaps(rows.withColumn("k", F.lit("k")), "k", F.to_date("t")).first()
    assert (g.arrivals, g.longest_gap) == (4, 4)


def test_selection(spark):
    assert spark.range(1).select(selection.score(0.1, coverage_norm=F.lit(1.0), relevance=selection.relevance(F.lit(None).cast("double")), freshness=F.lit(None).cast("double")).alias("s")).first().s == pytest.approx(0.4 + 0.25 * 4 / 9 - 0.1)
    df = spark.createDataFrame([(i, i % 3) for i in range(10)], "id int, g int")
    dealt = {r.id: r.slot for r in selection.slots(df, [("big", 1), ("quick", 3)], [F.desc("id")]).collect()}
    assert dealt == {9: "big", 8: "quick", 7: "quick", 6: "quick"}
    assert sorted((r.g, r.id) for r in selection.top_per(df, "g", [F.desc("id")]).collect()) == [(0, 9), (1, 7), (2, 8)]
    assert selection.share(df.limit(0), "g").count() == 0


def test_routing(spark):
    segments = spark.createDataFrame([("1-A", "box+a@x.example"), ("2-B", "box@x.example")], "segment string, subscribe_email string")
    m = spark.createDataFrame([(1, "R <box+A@x.example>"), (2, "box+z@x.example"), (3, None)], "id int, t string")
    assert {r.id: r.segment for r in routing.by_tag(m, segments, F.col("t")).collect()} == {1: "1-A", 2: "unmatched", 3: "unmatched"}
    mail = spark.createDataFrame([(1, "Hello@SaffronAbacus.example", "x"), (2, "a@b.example", "READERBOX+BIZ@inbox.example"), (3, None, None)], "id int, f string, t string")
    got = {r.id: r.labels for r in routing.labels_by_rules(mail, X.RULES.spark(spark), "id", "f", "t").collect()}
    assert got == {1: ["Big", "Newsletters/4-HRPeopleOps"], 2: ["Newsletters/2-BizFinance"]}
    s = spark.createDataFrame([("Please confirm your address", "confirm", 0), ("We are going on a break", "engagement_check", 1), ("", "other", 0), (None, "other", 0), ("Rates", "issue", 1)], "s string, k string, i int")
    assert all(r.k == r.kind and r.i == r.issue for r in s.select("k", "i", routing.kind(F.col("s")).alias("kind"), routing.is_issue(F.col("s")).alias("issue")).collect())


def test_checks(spark):
    facts = spark.createDataFrame([(1, "exact words"), (1, "exact  words"), (2, "x"), (3, ""), (1, None)], "k int, e string")
    texts = spark.createDataFrame([(1, "some exact words here"), (3, "y")], "k int, t string")
    assert sorted((r.k, r.e or "", r.verified) for r in checks.verified(facts, texts, "k", "e", "t").collect()) == [(1, "", False), (1, "exact  words", False), (1, "exact words", True), (2, "x", False), (3, "", False)]
    claims = spark.createDataFrame([("e", "a", 81.0), ("e", "b", 110.0), ("f", "a", 5.0), ("f", "b", 5.0), ("g", "a", 1.0), ("g", "a", 9.0), ("h", "a", None)], "e string, s string, v double")
    assert [r.e for r in checks.conflicts(claims, "e", "s", "v").collect()] == ["e"] and checks.conflicts(claims, "e", "s", "v", 0.5).count() == 0
    sides = spark.createDataFrame([(1, "x"), (1, "y"), (2, "x"), (2, "x"), (3, None)], "d int, s string")
    assert [(r.d, r.claims, r.sides) for r in checks.splits(sides, "d", "s").collect()] == [(1, 2, ["x", "y"])]
    assert spark.range(1).select(edit_similarity(F.lit("abcd"), F.lit("abcf")).alias("x")).first().x == 0.75


def test_streams_equal_batches(spark, tmp_path):
    rows = [(i, f"2025-01-01 0{i // 20}:{i % 20:02d}:00", "ab"[i % 2], float(i)) for i in range(100)]
    df = spark.createDataFrame(rows, "id int, ts string, k string, value double").withColumn("ts", F.to_timestamp("ts").cast("timestamp_ntz"))
    df.repartition(3).write.parquet(str(tmp_path / "in"))
    stream = lambda: windows.stream(spark, str(tmp_path / "in"))
    batch = defaultdict(int)
    for _, ts, k, _ in rows:
        batch[ts[:13], k] += 1
    got = {(str(r.start)[:13], r.k): r.n for r in windows.drained(windows.tumbling(stream(), "ts", "k", "1 hour"), "complete").collect()}
    assert got == dict(batch)
    assert windows.drained(windows.deduplicated(stream(), "ts", ["k"], "1 day")).count() == 2
    for _ in range(2):
        windows.append_stream(stream(), str(tmp_path / "out"), "id", str(tmp_path / f"state{_}"))
    assert spark.read.parquet(str(tmp_path / "out")).count() == 100
    seen = df.groupBy("k").agg(F.max("ts").alias("last_ts"))
    assert windows.silences(seen, F.to_date(F.lit("2025-03-01")), 30).count() == 2


def test_every_edition_is_numbered(spark, tmp_path):
    from newsloom.plans import reference_corpus as Q

    rows = [(1, "a", "3-Legal", "2025-01-02", 5, "teaser"), (2, "a", "3-Legal", "2025-01-01", 6, "article"), (3, "a", "1-Tech", "2025-01-03", 7, "article"), (4, "a", None, "2025-01-03", 8, "article"), (5, "a", None, "2025-01-03", 9, "teaser"), (6, None, "1-Tech", "2025-01-01", 1, "article")]
    spark.createDataFrame(rows, "doc_id bigint, source string, segment string, d string, n_chars bigint, content_shape string").selectExpr("*", "CAST(d AS date) AS issue_date").write.parquet(str(tmp_path / "documents.parquet"))
    assert sorted((r.doc_id, r.issue_no) for r in Q.issue_numbers(spark, str(tmp_path)).collect()) == [(1, 2), (2, 1), (3, 1), (4, 1), (5, 2)]
    assert {(r.segment, str(r.issue_date)): r.issue.count("doc_id") for r in Q.issue_json(spark, str(tmp_path)).collect()} == {("3-Legal", "2025-01-02"): 1, ("3-Legal", "2025-01-01"): 1, ("1-Tech", "2025-01-03"): 1}


def test_later_entities_and_those_of_the_body_link(spark, tmp_path):
    from newsloom.plans import reference_corpus as Q

    rows = [(1, "Amber meets Copper\nand then Ledger, xLedger"), (2, "Granite buys Copper"), (3, "Nothing\nLedger and Ledger"), (4, None), (5, "xLedger Ledgeré")]
    spark.createDataFrame(rows, "doc_id bigint, text string").write.parquet(str(tmp_path / "documents.parquet"))
    assert sorted(tuple(r) for r in Q.entity_links(spark, str(tmp_path)).select("a", "b", "entity").collect()) == [(1, 2, "Copper"), (1, 3, "Ledger")]


def test_names_of_any_ending_are_counted(spark, tmp_path):
    from newsloom.plans import reference_corpus as Q

    rows = [(1, "When Siemens met Müller. Then Siemens left.\nAgain “Quokelo” won"), (2, "“Still” at Siemens"), (3, None)]
    spark.createDataFrame(rows, "doc_id bigint, text string").write.parquet(str(tmp_path / "documents.parquet"))
    assert sorted(tuple(r) for r in Q.entity_mentions(spark, str(tmp_path)).collect()) == [("Müller", 1, 1), ("Quokelo", 1, 1), ("Siemens", 2, 3)]
