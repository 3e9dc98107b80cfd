"""At-least-once delivery reduced to exactly one row per identifier.

Identifiers are split by their aggregated frequency: an identifier seen once passes on untouched, only the rows of repeated
identifiers are ranked, and both parts are united. Counting and ranking are aggregates with a map-side combine, so an
identifier that holds a third of all rows shrinks to one row per task before the shuffle.

Defined results. Rows whose identifier is null or blank can't be compared and are all kept. Of tied first rows exactly one
is kept (they tie in `order`; the smaller hash of the whole row decides). Extra columns pass through, whatever their names;
an empty table gives an empty table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsloom.plans.durable import durable, join_counted
from newsloom.sources.tables import canonical_id

KEY, ORDER, ROW, COUNT, FIRST = "_nl_key", "_nl_order", "_nl_row", "_nl_rows", "_nl_first"


def _keyed(df: DataFrame, key: str, order: str) -> DataFrame:
    """The identifier, the order and the row as one value, so that no name of the input can clash with ours."""
    return df.select(canonical_id(F.col(f"`{key}`")).alias(KEY), F.col(f"`{order}`").alias(ORDER), F.struct(*(F.col(f"`{c}`") for c in df.columns)).alias(ROW))


def frequencies(df: DataFrame, key: str = "msg_id", order: str = "delivery_id") -> DataFrame:
    """One row per identifier: its rows and its smallest `order`."""
    return _keyed(df, key, order).filter(F.col(KEY).isNotNull()).groupBy(KEY).agg(F.count(F.lit(1)).alias(COUNT), F.min(ORDER).alias(FIRST))


def _repeated(df: DataFrame, key: str, order: str) -> tuple[DataFrame, int]:
    kept = durable(frequencies(df, key, order).filter(F.col(COUNT) > 1))
    return kept, int(kept.agg(F.sum(COUNT)).first()[0] or 0)


def _once(keyed: DataFrame, repeated: DataFrame, total: int) -> DataFrame:
    """The rows whose identifier stands once or is missing. Hot identifiers are dropped where they are read, and rows without
    one never go through a join, so what is shuffled is spread evenly."""
    if not total:
        return keyed
    named, unnamed = keyed.filter(F.col(KEY).isNotNull()), keyed.filter(F.col(KEY).isNull())
    return join_counted(named, repeated, KEY, COUNT, total, "left_anti").unionByName(unnamed)


def keep_one(stored: DataFrame, new: DataFrame | None = None, key: str = "msg_id", order: str = "delivery_id", fill: tuple[str, ...] = ()) -> DataFrame:
    """All stored and new rows with exactly one row per identifier: the one with the smallest `order`.

    The identifier comes out in canonical form. A null `order` counts as last. The columns in `fill`, where null or blank in
    the kept row, take the value of the first delivery that has one.
    """
    df = stored if new is None else stored.unionByName(new, allowMissingColumns=True)
    repeated, total = _repeated(df, key, order)
    keyed = _keyed(df, key, order)
    field = lambda c: F.col(ROW).getField(c)
    rank = F.struct(F.col(ORDER).isNull(), ORDER, F.xxhash64(ROW))
    filled = [F.min_by(field(c), F.when(F.trim(field(c).cast("string")) != "", rank)).alias(f"_nl_fill_{i}") for i, c in enumerate(fill)]
    ranked = join_counted(keyed, repeated, KEY, COUNT, total).groupBy(KEY).agg(F.min_by(ROW, rank).alias(ROW), *filled)
    singles = _once(keyed, repeated, total).select(KEY, ROW, *(field(c).alias(f"_nl_fill_{i}") for i, c in enumerate(fill)))
    out = []
    for c in df.columns:
        own = field(c)
        if c in fill:
            own = F.when(F.trim(own.cast("string")) != "", own).otherwise(F.col(f"_nl_fill_{fill.index(c)}"))
        out.append((F.coalesce(KEY, own) if c == key else own).alias(c))
    return singles.unionByName(ranked).select(*out)


def surplus(df: DataFrame, key: str = "msg_id", order: str = "delivery_id") -> DataFrame:
    """Every row but the kept one of each repeated identifier, as (key, order)."""
    repeated, total = _repeated(df, key, order)
    rows = durable(join_counted(_keyed(df, key, order).select(KEY, ORDER), repeated, KEY, COUNT, total).select(KEY, ORDER, FIRST))  # used twice
    later = rows.filter(F.col(FIRST).isNotNull() & (F.col(ORDER).isNull() | (F.col(ORDER) > F.col(FIRST)))).select(KEY, ORDER)
    # all but one of the rows that tie as first (a group without any `order` ties as a whole)
    ties = rows.filter(F.col(ORDER).eqNullSafe(F.col(FIRST))).groupBy(KEY, ORDER).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    tied = ties.withColumn("_", F.explode(F.expr("sequence(2, n)"))).select(KEY, ORDER)
    return later.unionByName(tied).select(F.col(KEY).alias(key), F.col(ORDER).alias(order))


def alias_groups(messages: DataFrame, key: str, message_id: str, *content: str) -> DataFrame:
    """(kept, copies): messages that are one although their keys differ, by Message-ID or, where there is none, by their content
    (sender, subject, date); the smallest key is kept. Null contents are equal to each other and to empty ones."""
    texts = F.concat_ws("\u0001", *(F.coalesce(F.col(c).cast("string"), F.lit("")) for c in content))
    group = F.coalesce(F.nullif(F.trim(message_id), F.lit("")), F.sha2(texts, 256))
    return messages.groupBy(group.alias("_g")).agg(F.min(key).alias("kept"), F.count(F.lit(1)).alias("copies")).drop("_g")
