"""Repeated lines against brute force, with a hot source, few documents, long documents and blank variants."""

import random
import re
from collections import Counter, defaultdict

from newsloom.llm import boilerplate as B


def normal(line):
    return re.sub("[0-9]+", "0", re.sub(r"[ \t\r]+", " ", line).strip(" ")).lower()


def brute(docs):
    per = defaultdict(list)
    for key, source, text in docs:
        if text and source is not None:
            per[source].append((key, text.split("\n")))
    out = set()
    for own in per.values():
        n = Counter(x for _, lines in own for x in {normal(t) for t in lines if any(c.isalpha() for c in t)})
        hit = {x for x, c in n.items() if c >= 5 and c >= 0.2 * len(own)}
        out |= {(k, i) for k, lines in own for i, t in enumerate(lines) if any(c.isalpha() for c in t) and normal(t) in hit}
    return out


def docs(seed=3, n=900):
    r = random.Random(seed)
    out = []
    for i in range(n):
        s = "hot" if i % 3 == 0 else f"s{r.randrange(40)}"
        lines = [f"word{r.randrange(5000)} tells {r.randrange(9999)} of it" + "abcdefgh"[r.randrange(8)] for _ in range(r.randrange(12))]
        if r.random() < 0.5:
            lines.append(f"Issue  No. {i} of {s}\r")
        if r.random() < 0.2:
            lines += ["Unsubscribe HERE", " unsubscribe here\t"]
        r.shuffle(lines)
        out.append((f"m{i}", s, "\n".join(lines)))
    return out + [("x1", None, "a\nb"), ("x2", "s1", None), ("x3", "s1", ""), ("x4", "one", "\n".join(f"line {chr(97 + j % 26)}{chr(97 + j // 26 % 26)}{chr(97 + j // 676)}" for j in range(9000)))]


def test_against_brute_force(spark):
    data = docs()
    df = spark.createDataFrame(data, "id string, source string, text string").repartition(7)
    got = {(r.id, r.line_no) for r in B.found_lines(df, "id", "source", "text").collect()}
    assert got == brute(data) and len(got) > 200
    clean = {r.id: r.clean for r in B.without_lines(df, "id", "source", "text").collect()}
    for k, _, t in data:
        kept = None if t is None else "\n".join(x for i, x in enumerate(t.split("\n")) if (k, i) not in got)
        assert clean[k] == kept


def test_long_documents_are_counted_exactly(spark):
    body = "\n".join(f"l{'abcdefghij'[j % 10]}{'abcdefghij'[j // 10 % 10]}{'abcdefghij'[j // 100 % 10]}{'abcdefghij'[j // 1000 % 10]}" for j in range(6000))
    data = [(f"d{i}", "big", body if i < 6 else f"only {'abcdefghij'[i % 10]}") for i in range(10)]
    df = spark.createDataFrame(data, "id string, source string, text string")
    assert B.found_lines(df, "id", "source", "text").count() == len(brute(data)) == 36_000


def test_empty(spark):
    df = spark.createDataFrame([], "id string, source string, text string")
    assert B.found_lines(df, "id", "source", "text").count() == 0 and B.without_lines(df, "id", "source", "text").count() == 0


def test_sources_beside_and_hot_keys_split(spark, monkeypatch):
    monkeypatch.setattr(B, "BROADCAST_ROWS", 0)
    data = docs()
    texts, who = spark.createDataFrame([(k, t) for k, _, t in data], "id string, text string"), spark.createDataFrame([(k, s) for k, s, _ in data], "id string, source string")
    assert {(r.id, r.line_no) for r in B.found_lines(texts, "id", "source", "text", sources=who).collect()} == brute(data)
