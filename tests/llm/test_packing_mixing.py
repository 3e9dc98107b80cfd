"""Containers and mixtures: invariants, optimal boundaries, target shares."""

import itertools
import random
from collections import defaultdict

import numpy as np
from pyspark.sql import functions as F

from newsloom.llm import mixing, packing, tokens


def padding(bounds, lengths, counts):
    where = np.searchsorted(bounds, lengths)
    return int(((bounds[where] - lengths) * counts).sum())


def test_boundaries_are_optimal():
    r = random.Random(5)
    for _ in range(40):
        lengths = np.array(sorted(r.sample(range(1, 60), r.randrange(3, 9))))
        counts = np.array([r.randrange(1, 50) for _ in lengths])
        for k in range(1, 5):
            best = min(padding(np.array([*c, lengths[-1]]), lengths, counts) for c in itertools.combinations(lengths[:-1], min(k, len(lengths)) - 1))
            got = packing.boundaries(lengths, counts, k)
            assert len(got) <= max(k, 1) and padding(got, lengths, counts) == best


def test_plan_uses_everything_once():
    bounds, counts = np.array([3, 10, 40, 70, 100]), np.array([1000, 37, 11, 5, 3])
    segments = packing.plan(bounds, counts, 100)
    room, per = defaultdict(int), defaultdict(int)
    for s in segments:
        per[s.bound] += s.last - s.first
        for i in range((s.last - s.first) // s.each):
            room[s.base + i] += s.each * s.bound
    assert dict(per) == dict(zip(bounds.tolist(), counts.tolist(), strict=True)) and max(room.values()) <= 100


def test_packed(spark):
    r = random.Random(2)
    items = [(i, r.choice([1, 7, 300, 511, 512, 513, 5000, r.randrange(1, 900)])) for i in range(4000)] + [(5000, 0), (5001, None), (5002, -3)]
    df = spark.createDataFrame(items, "id int, tokens int").repartition(6)
    kinds = spark.createDataFrame([("small", 512), ("large", 4096), ("none", 0)], "container_kind string, capacity_tokens int")
    rows = packing.pack(df, kinds, "id").collect()
    fill, parts = defaultdict(int), defaultdict(list)
    for x in rows:
        fill[x.container_kind, x.container_id] += x.tokens
        parts[x.container_kind, x.id].append((x.piece_no, x.tokens))
    caps = {"small": 512, "large": 4096}
    assert all(v <= caps[k] for (k, _), v in fill.items()) and {k for k, _ in fill} == set(caps)
    for kind, cap in caps.items():
        for i, n in items:
            own = sorted(parts.get((kind, i), []))
            assert [t for _, t in own] == ([] if not n or n < 1 else [cap] * ((n - 1) // cap) + [n - cap * ((n - 1) // cap)])
        used = [v for (k, _), v in fill.items() if k == kind]
        assert sum(used) / (len(used) * cap) > 0.95  # an eighth of the items is 300, of which no two fit into 512
    again = packing.pack(df.repartition(2), kinds, "id").collect()
    assert sorted(map(tuple, rows)) == sorted(map(tuple, again))
    assert packing.pack(df.limit(0), kinds, "id").count() == 0


def divide(budget, weights, limits):
    """The plain way: what is full leaves its rest to the others, again and again."""
    out, left, open_ = [0.0] * len(weights), budget, {i for i, (w, x) in enumerate(zip(weights, limits, strict=True)) if w > 0 and x > 0}
    while open_ and left > 1e-9:
        total = sum(weights[i] for i in open_)
        full = {i for i in open_ if limits[i] - out[i] <= left * weights[i] / total}
        if not full:
            for i in open_:
                out[i] += left * weights[i] / total
            break
        for i in full:
            left -= limits[i] - out[i]
            out[i] = limits[i]
        open_ -= full
    return out


def by_tree(leaves, total, path=("domain", "lang")):
    if not path:
        return {(x["domain"], x["lang"], x["source"]): p for x, p in zip(leaves, divide(total, [x["weight"] for x in leaves], [x["limit"] for x in leaves]), strict=True)}
    branches = defaultdict(list)
    for x in leaves:
        branches[x[path[0]]].append(x)
    groups = list(branches.values())
    parts = divide(total, [sum(x["weight"] for x in g) for g in groups], [sum(x["limit"] for x in g if x["weight"] > 0) for g in groups])
    return {k: v for g, p in zip(groups, parts, strict=True) for k, v in by_tree(g, p, path[1:]).items()}


def budgets(spark, leaves, total):
    df = spark.createDataFrame([(x["source"], x["domain"], x["lang"], float(x["weight"]), float(x["limit"])) for x in leaves], "source string, domain string, lang string, weight double, limit double")
    return {(r.domain, r.lang, r.source): r.budget for r in mixing.budgets(df, F.lit(float(total))).collect()}


def test_large_capacities_and_many_kinds(spark, monkeypatch):
    monkeypatch.setattr(packing, "GRAINS", 64)
    monkeypatch.setattr(packing, "KINDS_AT_ONCE", 1)
    monkeypatch.setattr(packing, "PART_ROWS", 50)
    r = random.Random(3)
    items = [(i, r.choice([1000, 999, r.randrange(1, 2500)])) for i in range(1500)]
    kinds = spark.createDataFrame([("a", 1000), ("b", 130)], "container_kind string, capacity_tokens int")
    fill = defaultdict(int)
    placed = defaultdict(int)
    for x in packing.pack(spark.createDataFrame(items, "id int, tokens int"), kinds, "id").collect():
        fill[x.container_kind, x.container_id] += x.tokens
        placed[x.container_kind, x.id] += x.tokens
    assert max(v for (k, _), v in fill.items() if k == "a") <= 1000 and max(v for (k, _), v in fill.items() if k == "b") <= 130
    assert all(placed[k, i] == n for k in "ab" for i, n in items)


def test_many_lengths_take_seconds():
    lengths, counts = np.arange(1, 20_001), np.random.default_rng(1).integers(1, 1000, 20_000)
    bounds = packing.boundaries(lengths, counts, 64)
    even = np.linspace(0, 20_000, 65).astype(int)[1:]
    assert len(bounds) == 64 and bounds[-1] == 20_000 and padding(bounds, lengths, counts) <= padding(even, lengths, counts)


def test_shortage_goes_to_siblings_first(spark):
    leaf = lambda s, d, l, w, n: {"source": s, "domain": d, "lang": l, "weight": w, "limit": n}  # noqa: E731, E741
    got = {k[2]: v for k, v in budgets(spark, [leaf("a", "x", "en", 0.25, 10), leaf("b", "x", "en", 0.25, 1000), leaf("c", "x", "de", 0.25, 1000), leaf("d", "y", "en", 0.25, 1000)], 400).items()}
    assert got["a"] == 10 and abs(got["b"] - 190) < 1e-6 and abs(got["c"] - 100) < 1e-6 and abs(got["d"] - 100) < 1e-6
    short = {k[2]: v for k, v in budgets(spark, [leaf("a", "x", "en", 0.5, 10), leaf("d", "y", "en", 0.5, 1000)], 400).items()}
    assert short == {"a": 10, "d": 390}


def test_budgets_against_the_plain_way(spark):
    r = random.Random(8)
    for total in (50, 2000, 10**6):
        leaves = [{"source": f"s{i}", "domain": d, "lang": x, "weight": r.choice([0, r.random()]), "limit": r.choice([0, 5, r.randrange(1, 900)])} for i in range(9) for d in "abc" for x in ("en", "de") if r.random() < 0.7]
        got, want = budgets(spark, leaves, total), by_tree(leaves, total)
        assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-6 for k in want)


def test_a_source_stands_in_all_its_branches(spark):
    r = random.Random(6)
    rows = [(i, f"s{i % 3}", r.choice(["en", "de", None]), r.choice(["x", "y", None]), r.randrange(1, 400)) for i in range(3000)]
    sized = spark.createDataFrame(rows, "doc_id int, source string, lang string, segment string, tokens int")
    targets = spark.createDataFrame([("s0", 0.5, 2), ("s1", 0.2, 9), ("s2", 0.1, 1), ("absent", 0.2, 4)], "source string, target_share double, max_repeats int")
    taken, leaves = mixing.mix(sized, targets)
    assert leaves.count() == 27
    got = {x.source: x for x in mixing.report(taken, leaves, targets).collect()}
    for s, share in (("s0", 0.5 / 0.8), ("s1", 0.2 / 0.8), ("s2", 0.1 / 0.8)):  # the absent share goes to all, by weight
        assert abs(got[s].actual_share - share) < 0.002 and got[s].leaves == 9
        assert got[s].budget_tokens - 400 < got[s].taken_tokens <= got[s].budget_tokens
    assert got["absent"].taken_tokens == 0
    whole = sum(t for *_, t in rows)
    assert abs(sum(x.budget_tokens for x in got.values()) - whole) <= 27


def test_mix(spark):
    r = random.Random(4)
    rows = [(i, "hot" if i % 3 else f"s{i % 5}", "en", "g", r.randrange(1, 400)) for i in range(3000)] + [(9000, "other", None, None, 5), (9001, None, "en", "g", 5)]
    sized = spark.createDataFrame(rows, "doc_id int, source string, lang string, segment string, tokens int").repartition(5)
    targets = spark.createDataFrame([("hot", 0.2, 1), ("s0", 0.3, 3), ("s1", 0.2, 2), ("s2", 0.2, 4), ("gone", 0.1, 4), ("null", None, None)], "source string, target_share double, max_repeats int")
    taken, leaves = mixing.mix(sized, targets, 300_000)
    rows_taken, plan = taken.collect(), {x.source: x for x in leaves.collect()}
    sums, most = defaultdict(int), defaultdict(int)
    for x in rows_taken:
        sums[x.source] += x.tokens * x.times
        most[x.source] = max(most[x.source], x.times)
    caps = {"hot": 1, "s0": 3, "s1": 2, "s2": 4}
    assert set(sums) == set(caps) and all(most[s] <= caps[s] for s in caps)
    for s in caps:
        assert plan[s].budget - 400 < sums[s] <= plan[s].budget
    assert sorted(map(tuple, mixing.mix(sized.repartition(2), targets, 300_000)[0].collect())) == sorted(map(tuple, rows_taken))
    report = {x.source: x for x in mixing.report(taken, leaves, targets).collect()}
    assert abs(sum(x.actual_share for x in report.values()) - 1) < 1e-4 and report["gone"].taken_tokens == 0
    assert mixing.mix(sized.limit(0), targets)[0].count() == 0


def test_sizes(spark):
    df = spark.createDataFrame([(1, "one two three", 9), (2, "", 9), (3, None, 9), (4, "wörter " * 30_000, 9)], "id int, text string, tokens int")
    got = {r.id: r.tokens for r in tokens.sized(df, "id", "text").collect()}
    assert got[1] == 3 and set(got) == {1, 4} and got[4] == tokens.count("wörter " * 30_000)
