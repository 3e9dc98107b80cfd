"""Similarity joins that lose no link, over classes of equal sets, and groups of linked items."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsloom.functions.text import jaccard, token_set
from newsloom.plans.durable import durable, join_counted

#: Bytes of the query vectors that go over the rows at once; queries of one matrix product.
QUERY_BYTES, QUERY_BLOCK = 64 << 20, 4096
#: Tables are broadcast up to so many rows.
BROADCAST_ROWS = 200_000


def classes(items: DataFrame, key: str, text: str) -> tuple[DataFrame, DataFrame]:
    """(class_id, tokens), one row per distinct token set, and (key, class_id) of all items with a token. Equal sets are one
    class, named by its smallest key, so copies are never paired with each other."""
    sets = items.select(key, token_set(F.col(text)).alias("tokens")).filter(F.size("tokens") > 0)
    named = durable(sets.groupBy("tokens").agg(F.min(key).alias("class_id"), F.count(F.lit(1)).alias("n")))
    total = named.agg(F.sum("n")).first()[0] or 0
    return named.select("class_id", "tokens"), join_counted(sets, named, "tokens", "n", total).select(key, "class_id")


def jaccard_pairs(sets: DataFrame, threshold: float, key: str = "class_id", tokens: str = "tokens") -> DataFrame:
    """(a, b, similarity), a < b: all pairs with at least the threshold.

    Tokens are ordered from rare to common. Two sets of that similarity share one of their first n - ceil(t*n) + 1 tokens, so
    only those are joined. The larger set goes to each size that the smaller one may have, so that the join is on token and
    size, with the filter on the position of the shared token in the join itself: a common token is split by sizes.
    """
    exploded = sets.select(key, F.size(tokens).alias("n"), F.explode(tokens).alias("token"))
    df = durable(exploded.groupBy("token").agg(F.count(F.lit(1)).alias("df")))
    total = df.agg(F.sum("df")).first()[0] or 0
    ranked = join_counted(exploded, df, "token", "df", total).groupBy(key, "n").agg(F.array_sort(F.collect_list(F.struct("df", "token"))).alias("o"))
    kept = ranked.withColumn("p", (F.col("n") - F.ceil(F.col("n") * threshold - 1e-9) + 1).cast("int"))
    prefix = durable(kept.select(key, "n", F.posexplode(F.expr("slice(o, 1, p)")).alias("i", "x")).select(key, "n", "i", F.col("x.token").alias("token")))
    a, b = prefix.alias("a"), prefix.withColumn("m", F.explode(F.sequence(F.ceil(F.col("n") * threshold - 1e-9).cast("int"), F.col("n")))).alias("b")
    least = F.ceil((F.col("a.n") + F.col("b.n")) * (threshold / (1 + threshold)) - 1e-9)
    after = F.least(F.col("a.n") - F.col("a.i"), F.col("b.n") - F.col("b.i"))  # tokens from the shared one on
    one, two = F.col(f"a.{key}"), F.col(f"b.{key}")
    near = ((F.col("a.n") < F.col("b.n")) | (one < two)) & (after >= least - F.least("a.i", "b.i"))
    found = a.join(b, (F.col("a.token") == F.col("b.token")) & (F.col("a.n") == F.col("b.m")) & near).select(F.least(one, two).alias("a"), F.greatest(one, two).alias("b")).distinct()
    left, right = sets.select(F.col(key).alias("a"), F.col(tokens).alias("ta")), sets.select(F.col(key).alias("b"), F.col(tokens).alias("tb"))
    return found.join(left, "a").join(right, "b").withColumn("similarity", jaccard(F.col("ta"), F.col("tb"))).filter(F.col("similarity") >= threshold - 1e-9).select("a", "b", "similarity")


def star_edges(items: DataFrame, key: str, value: str) -> DataFrame:
    """(a, b, value): each item that shares the value, linked to the smallest of them. As many edges as items: enough for
    groups, and a value that half of all items share stays linear."""
    first = items.groupBy(value).agg(F.min(key).alias("a"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    total = items.count()
    return join_counted(items.select(key, value), durable(first), value, "n", total).filter(F.col(key) > F.col("a")).select("a", F.col(key).alias("b"), value)


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component): the smallest node that each node is linked with, however far.

    Alternates large-star and small-star: every round links nodes straight to the smallest neighbour, so that the number
    of rounds grows with the logarithm of the longest path. Each round is written to the shared folder.
    """
    now = durable(edges.filter(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct())
    mark = _signature(now)
    while True:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        small = 2 * mark[0] <= BROADCAST_ROWS  # of the edges; neither step makes more of them
        larger = _to_smallest(both, True, small)
        now = durable(_to_smallest(larger if small else durable(larger), False, small))
        before, mark = mark, _signature(now)
        if mark == before:
            break
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())


def _signature(edges: DataFrame) -> tuple:
    """Number and sum of hashes of distinct edges: equal for equal sets."""
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")), F.sum(F.hash("u", "v").cast("long"))).first())


def _to_smallest(edges: DataFrame, larger_only: bool, small: bool) -> DataFrame:
    """Each neighbour v of u (and u itself) linked to the smallest of u and its neighbours; of all neighbours or the smaller."""
    if not larger_only:
        edges = edges.filter("v < u")
    low = edges.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"), F.count(F.lit(1)).alias("n"))
    if small:
        joined = edges.join(F.broadcast(low), "u")
    else:
        low = durable(low)
        joined = join_counted(edges, low, "u", "n", low.agg(F.sum("n")).first()[0] or 0)
    out = joined.filter("v > u") if larger_only else joined.filter("v <> m").unionByName(joined.select("u", F.col("u").alias("v"), "m", "n"))
    return out.select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()


def cosine_neighbours(rows: DataFrame, queries: DataFrame, threshold: float, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(query_id, key, cosine) of all rows at or above the threshold for a stated set of queries, exactly.

    The queries go over the rows in blocks of QUERY_BYTES, a bound on what is broadcast at once, in matrix products of
    QUERY_BLOCK vectors. Rows without a vector or of length zero have no cosine. A row is no neighbour of itself.
    """
    spark = rows.sparkSession
    numbered = queries.select(F.col(key).alias("q"), F.col(vector).alias("v")).filter(F.col(vector).isNotNull())
    count, width = numbered.agg(F.count(F.lit(1)), F.max(F.size("v"))).first()
    blocks = max(1, -(-count * 8 * (width or 1) // QUERY_BYTES))
    kind = rows.schema[key].dataType.simpleString()
    parts = []
    for i in range(blocks):
        own = numbered.filter(F.pmod(F.xxhash64("q"), F.lit(blocks)) == i).toPandas()  # about QUERY_BYTES
        if own.empty:
            continue
        m = np.array(own["v"].tolist(), dtype=float)
        size = np.linalg.norm(m, axis=1)
        shared = spark.sparkContext.broadcast((own["q"].to_numpy()[size > 0], (m / np.where(size > 0, size, 1)[:, None])[size > 0]))

        def run(batches: Iterator[pd.DataFrame], shared=shared) -> Iterator[pd.DataFrame]:
            ids, q = shared.value
            for b in batches:
                x = np.array(b["v"].tolist(), dtype=float).reshape(len(b), -1)
                n = np.linalg.norm(x, axis=1)
                if not len(b):
                    continue
                unit = x / np.where(n > 0, n, 1)[:, None]
                for at in range(0, len(ids), QUERY_BLOCK):
                    cos = unit @ q[at : at + QUERY_BLOCK].T
                    r, c = np.nonzero(cos >= threshold)
                    out = pd.DataFrame({"query_id": ids[at + c], key: b["k"].to_numpy()[r], "cosine": cos[r, c]})
                    yield out[out["query_id"] != out[key]]

        slim = rows.filter(F.col(vector).isNotNull()).select(F.col(key).alias("k"), F.col(vector).alias("v"))
        parts.append(slim.mapInPandas(run, f"query_id {kind}, {key} {kind}, cosine double"))
    if not parts:
        return spark.createDataFrame([], f"query_id {kind}, {key} {kind}, cosine double")
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
