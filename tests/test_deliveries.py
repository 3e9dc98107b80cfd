"""One row per identifier, against brute force, with hot identifiers, ties, nulls and clashing columns."""

import random
from collections import defaultdict

from newsloom.operators import deliveries
from newsloom.plans import durable

SCHEMA = "delivery_id bigint, msg_id string, thread_id string, `_nl_rows` string, `a.b` int"


def rows(n=3000, seed=1):
    r = random.Random(seed)
    out = []
    for i in range(n):
        m = "hot" if r.random() < 0.34 else f"M{r.randrange(n // 2)}"
        out.append((i, r.choice([m, m.upper(), f" {m.lower()} "]), r.choice([None, "", f"t{m.lower()}"]), "x", i % 3))
    return out + [(n, None, "t", "x", 1), (n + 1, "  ", "t", "y", 2), (None, "m1", "t", "z", 0)]


def key(m):
    return "".join((m or "").lower().split()) or None


def test_against_brute_force(spark):
    data = rows()
    df = spark.createDataFrame(data, SCHEMA).repartition(5)
    groups = defaultdict(list)
    for r in data:
        groups[key(r[1])].append(r)
    order = lambda r: (r[0] is None, r[0] or 0)
    surplus = sorted((k, r[0]) for k, g in groups.items() if k for r in sorted(g, key=order)[1:] if r[0] is not None)
    found = [tuple(r) for r in deliveries.surplus(df).collect()]
    assert sorted(x for x in found if x[1] is not None) == surplus
    assert sum(x[1] is None for x in found) == 1
    kept = deliveries.keep_one(df, fill=("thread_id",)).collect()
    assert len(kept) == sum(1 for k in groups if k) + len(groups[None])
    for r in kept:
        if key(r.msg_id):
            g = sorted(groups[key(r.msg_id)], key=order)
            assert r.msg_id == key(r.msg_id) and r.delivery_id == g[0][0]
            assert (r.thread_id or None) == next((x[2] for x in g if (x[2] or "").strip()), None)
    assert kept[0].asDict().keys() == set(df.columns)


def test_ties_and_empty(spark):
    df = spark.createDataFrame([(1, "a", None, "x", 1)] * 3 + [(None, "b", None, "x", 1)] * 2, SCHEMA)
    assert deliveries.keep_one(df).count() == 2
    assert sorted(r.msg_id for r in deliveries.surplus(df).collect()) == ["a", "a", "b"]
    assert deliveries.keep_one(df.limit(0)).count() == 0 and deliveries.surplus(df.limit(0)).count() == 0


def test_stored_and_new(spark):
    old = spark.createDataFrame([(1, "a", "t", "x", 1), (2, "b", "t", "x", 1)], SCHEMA)
    new = spark.createDataFrame([(3, "A", "t", "x", 1), (4, "c", "t", "x", 1)], SCHEMA)
    once = deliveries.keep_one(old, new)
    assert sorted((r.msg_id, r.delivery_id) for r in once.collect()) == [("a", 1), ("b", 2), ("c", 4)]
    assert deliveries.keep_one(once, new).exceptAll(once).isEmpty()


def test_hot_keys_are_bounded():
    assert all(total // (durable.hot_threshold(total) + 1) <= durable.HOT_PARTS for total in (1, 999, 1000, 5_000_000))
