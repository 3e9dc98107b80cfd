"""Items of varying length packed into containers of fixed capacity.

1. An item above the capacity is cut into full containers and a rest; no other item is split.
2. The global histogram of lengths goes to the driver: at most GRAINS numbers a kind, whatever the data (the lengths of larger
   capacities are rounded up to grains for planning, so that a container is never overfull).
3. Dynamic programming over it chooses the bucket boundaries with the least padding, exactly: a price for each bucket turns it
   into a problem in one dimension, solved along the lower envelope of lines; the price is searched by halving.
4. Token-budget batches form inside each bucket: a container takes as many items of its bucket as the budget allows. Items
   above half the capacity would then sit alone, so the room that a batch leaves is topped up from the smaller buckets that
   fit. Both work on the counts of the buckets: a plan is a short list of patterns with their number of containers.
5. Items are ranked inside their bucket without any task seeing a whole bucket (ranks in hash parts whose number follows from
   the counts, plus the sizes of the parts before) and find their pattern by the block of their rank, their container by
   arithmetic.

The result depends on the items only, not on partitions. Defined results: null, zero and negative lengths need no container;
ties are ranked by key; equal rows are packed each; an empty table gives no containers.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import window as W

from newsloom.plans.durable import join_counted

#: Buckets at most for each capacity; distinct lengths that are told apart; items of a part or a block of ranks on average.
BUCKETS, GRAINS, PART_ROWS = 256, 1 << 20, 50_000
#: Kinds of containers planned at once; more go in turns.
KINDS_AT_ONCE = 1000
#: Tables are broadcast up to so many rows.
BROADCAST_ROWS = 200_000


def _priced(b: list[int], h: list[int], s: list[int], price: int, scale: int) -> list[int]:
    """The bounds (as numbers of lengths covered, from 0) of the buckets with the least padding * scale + price * buckets.

    With one more bucket, from length i on, the first j lengths cost best_i + price + scale * (b_j * (H_j - H_i) - (S_j - S_i)),
    where H and S are running counts and totals: lines in b_j whose slopes fall, so that one pass over the lower envelope
    serves all j.
    """
    n = len(b)
    cut, line, value, head = [0] * (n + 1), [0], [0], 0
    line_h = [0]
    for j in range(1, n + 1):
        x = b[j - 1] * scale
        while head + 1 < len(line) and value[head + 1] - x * line_h[head + 1] <= value[head] - x * line_h[head]:
            head += 1
        cut[j] = line[head]
        v = price + x * (h[j] - line_h[head]) + value[head]  # best_j + scale * S_j
        while len(line) - head >= 2 and (v - value[-2]) * (line_h[-1] - line_h[-2]) <= (value[-1] - value[-2]) * (h[j] - line_h[-2]):
            line.pop(), value.pop(), line_h.pop()
        line.append(j), value.append(v), line_h.append(h[j])
    path = [n]
    while path[-1]:
        path.append(cut[path[-1]])
    return path[::-1]


def boundaries(lengths: np.ndarray, counts: np.ndarray, buckets: int = BUCKETS) -> np.ndarray:
    """The upper bounds of at most `buckets` buckets with the least total padding, sum of count * (bound - length).

    lengths is ascending. The least padding is convex in the number of buckets, so some whole price for a bucket makes that
    number one of the best. At this price the solution with the fewest buckets and that with the most are joined where a
    bucket of one holds a bucket of the other, which gives the very number.
    """
    n = len(lengths)
    if n <= buckets:
        return lengths
    b = [int(x) for x in lengths]
    h, s = [0], [0]
    for x, c in zip(b, counts, strict=True):
        h.append(h[-1] + int(c))
        s.append(s[-1] + int(c) * x)
    scale = 2 * n + 1  # so that a penny a bucket never outweighs a unit of padding
    solve = lambda price, penny: _priced(b, h, s, price * scale + penny, scale)
    low, high = -1, b[-1] * h[-1] + 1
    while high - low > 1:
        mid = (low + high) // 2
        if len(solve(mid, 1)) - 1 <= buckets:
            high = mid
        else:
            low = mid
    few, many = solve(high, 1), solve(high, -1)
    more = buckets - (len(few) - 1)
    path = few
    if more and len(many) - len(few) <= more:
        path = many
    elif more:
        i = next(i for i in range(len(few) - 1) if few[i] <= many[i + more] and many[i + more + 1] <= few[i + 1])
        path = many[: i + more + 1] + few[i + 1 :]
    return np.array([b[j - 1] for j in dict.fromkeys(path[1:])])


@dataclass(frozen=True)
class Segment:
    """Items of a bucket with ranks in [first, last) go, `each` to a container, to the containers from `base` on."""

    bound: int
    first: int
    last: int
    base: int
    each: int


def plan(bounds: np.ndarray, counts: np.ndarray, capacity: int) -> list[Segment]:
    """Patterns of containers over bucket counts: batches of the largest bucket left, topped up from smaller ones."""
    left = [int(c) for c in counts]
    used = [0] * len(left)
    out: list[Segment] = []
    base = 0
    top = len(left) - 1
    while top >= 0:
        if not left[top]:
            top -= 1
            continue
        room, pattern = capacity, {}
        at = top
        while at >= 0:  # at each step the largest bucket that fits, as often as it fits
            size = int(bounds[at])
            free = left[at] - pattern.get(at, 0)
            if free > 0 and size <= room:
                take = min(room // size, free)
                pattern[at] = pattern.get(at, 0) + take
                room -= take * size
            at = min(at - 1, int(np.searchsorted(bounds, room, side="right")) - 1)
        times = min(left[i] // m for i, m in pattern.items())
        for i, m in pattern.items():
            out.append(Segment(int(bounds[i]), used[i], used[i] + m * times, base, m))
            used[i] += m * times
            left[i] -= m * times
        base += times
    return out


def pieces(items: DataFrame, kinds: list[tuple], schema: str, key: str, tokens: str, kind: str) -> DataFrame:
    """(kind, capacity, key, piece_no, tokens): each item once per kind, cut only above the capacity."""
    each = F.array(*(F.struct(F.lit(name).alias(kind), F.lit(cap).cast("long").alias("capacity")) for name, cap in kinds)) if kinds else F.array().cast(f"array<struct<`{kind}`:{schema},capacity:bigint>>")
    both = items.filter(F.col(tokens) > 0).select(key, F.col(tokens).cast("long").alias("_n"), F.explode(each).alias("_k")).select(key, "_n", "_k.*")
    both = both.withColumn("piece_no", F.explode(F.sequence(F.lit(0), F.expr("CAST((_n - 1) DIV capacity AS INT)"))))
    return both.select(kind, "capacity", key, "piece_no", F.least(F.col("capacity"), F.col("_n") - F.col("piece_no") * F.col("capacity")).alias("tokens"))


def _blocks(segments: list[Segment], counts: dict[int, int]) -> list[tuple]:
    """(bound, block, first, last, base, each): each segment once for every block of ranks that it touches.

    A block of a bucket holds as many ranks as one of its segments on average and PART_ROWS at most, so a rank meets a few
    segments only and no block is large."""
    per: dict[int, list[Segment]] = {}
    for x in segments:
        per.setdefault(x.bound, []).append(x)
    out = []
    for bound, own in per.items():
        size = _block_size(counts[bound], len(own))
        out += [(bound, size, block, x.first, x.last, x.base, x.each) for x in own for block in range(x.first // size, (x.last - 1) // size + 1)]
    return out


def _block_size(rows: int, segments: int) -> int:
    return max(1, min(PART_ROWS, -(-rows // segments)))


def pack(items: DataFrame, containers: DataFrame, key: str, tokens: str = "tokens", kind: str = "container_kind", capacity: str = "capacity_tokens", buckets: int = BUCKETS) -> DataFrame:
    """(kind, container_id, key, piece_no, tokens): the container of each item or piece. containers is a small table of kinds."""
    kind_type = containers.schema[kind].dataType.simpleString()
    kinds = sorted(((r[0], int(r[1])) for r in containers.filter(F.col(capacity) > 0).select(kind, capacity).distinct().collect()), key=str)  # one row a kind
    parts = [_pack(items, kinds[i : i + KINDS_AT_ONCE], kind_type, key, tokens, kind, buckets) for i in range(0, max(1, len(kinds)), KINDS_AT_ONCE)]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _pack(items: DataFrame, kinds: list[tuple], kind_type: str, key: str, tokens: str, kind: str, buckets: int) -> DataFrame:
    spark = items.sparkSession
    grain = F.ceil(F.col("capacity") / GRAINS).cast("long")
    # the length in grains, rounded up; what fills a container alone may be a little longer than whole grains
    units = F.least(F.ceil(F.col("tokens") / grain), F.expr("capacity") / grain).cast("long")
    cut = pieces(items, kinds, kind_type, key, tokens, kind).withColumn("units", units)
    histogram: dict[tuple, list[tuple[int, int]]] = {}
    for r in cut.groupBy(kind, "capacity", "units").agg(F.count(F.lit(1)).alias("n")).collect():  # at most GRAINS rows a kind
        histogram.setdefault((r[kind], r["capacity"]), []).append((r["units"], r["n"]))
    lookup, segments = [], []
    for (name, cap), own in histogram.items():
        own.sort()
        lengths, counts = np.array([x[0] for x in own]), np.array([x[1] for x in own])
        bounds = boundaries(lengths, counts, buckets)
        where = np.searchsorted(bounds, lengths, side="left")
        totals = np.bincount(where, weights=counts, minlength=len(bounds)).astype(np.int64)
        found = plan(bounds, totals, cap // -(-cap // GRAINS))
        of = dict(zip(bounds.tolist(), totals.tolist(), strict=True))
        blocks = _blocks(found, of)
        size = {x[0]: x[1] for x in blocks}
        lookup += [(name, cap, int(n), int(c), b, -(-of[b] // PART_ROWS), size[b]) for n, c, b in zip(lengths, counts, bounds[where].tolist(), strict=True)]
        segments += [(name, cap, b, block, first, last, base, each) for b, _, block, first, last, base, each in blocks]
    to_bound = spark.createDataFrame(lookup, f"`{kind}` {kind_type}, capacity long, units long, n long, bound long, parts long, size long").select(F.struct(kind, "capacity", "units").alias("_key"), "n", "bound", "parts", "size")
    keyed = cut.withColumn("_key", F.struct(kind, "capacity", "units"))
    marked = keyed.join(F.broadcast(to_bound), "_key") if len(lookup) <= BROADCAST_ROWS else join_counted(keyed, to_bound, "_key", "n", sum(x[3] for x in lookup))
    bucket = [kind, "capacity", "bound"]
    marked = marked.withColumn("part", F.pmod(F.xxhash64(key, "piece_no"), F.col("parts"))).drop("_key", "units", "n", "parts")
    sizes = marked.groupBy(*bucket, "part").agg(F.count(F.lit(1)).alias("n"))
    before = W.Window.partitionBy(*bucket).orderBy("part").rowsBetween(W.Window.unboundedPreceding, -1)
    starts = sizes.select(*bucket, "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    inside = W.Window.partitionBy(*bucket, "part").orderBy(key, "piece_no")
    ranked = marked.withColumn("r", F.row_number().over(inside) - 1).join(starts, [*bucket, "part"]).withColumn("rank", F.col("start") + F.col("r")).withColumn("block", F.expr("rank DIV size"))
    plans = spark.createDataFrame(segments, f"`{kind}` {kind_type}, capacity long, bound long, block long, first long, last long, base long, each long")
    placed = ranked.join(F.broadcast(plans) if len(segments) <= BROADCAST_ROWS else plans, [*bucket, "block"]).filter((F.col("rank") >= F.col("first")) & (F.col("rank") < F.col("last")))
    return placed.select(kind, (F.col("base") + F.expr("(rank - first) DIV each")).alias("container_id"), key, "piece_no", "tokens")


def fill(packed: DataFrame, containers: DataFrame, kind: str = "container_kind", capacity: str = "capacity_tokens") -> DataFrame:
    """Per kind: containers, tokens and the share of unused space."""
    sums = packed.groupBy(kind).agg(F.countDistinct("container_id").alias("containers"), F.sum("tokens").alias("tokens"), F.count(F.lit(1)).alias("pieces"))
    return sums.join(F.broadcast(containers.select(kind, capacity)), kind).select(kind, "containers", "pieces", "tokens", F.round(1 - F.col("tokens") / (F.col("containers") * F.col(capacity)), 6).alias("unused_share"))
