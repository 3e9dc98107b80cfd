"""Lines that one source repeats through its documents, found and removed.

Texts are read once and become hashes of their lines where they are read; only these are joined with the sources and
shuffled. Per source, mergeable heavy-hitter summaries (frequent-items sketches that Catalyst aggregates on the map side) name
the candidate lines. A second pass counts the candidates exactly, and the lines that stand in enough of the source's documents
are removed from each document.

The summaries lose no line: a source's sketch holds the lines of D documents with L distinct lines each on average, so its
weight is D*L, and a frequent-items sketch of m counters underestimates no item by more than ERROR * D*L / m. m is chosen
above 2 * ERROR * L / share, so that every line in at least share * D documents stays in the sketch, whatever the number or
the size of the sources; m is chosen for each source by itself. Sources that would need more counters than a sketch can have
are counted exactly.

Sources and lines may be of any size: counting is partial on the map side, and the confirmed lines of a source are at most
L / share, so the set to remove is small against the texts; it is broadcast only below a size that is checked, else joined
with its hot keys split by their counts.

Defined results: null and empty texts are no documents; a text without repeated lines comes back unchanged; lines without a
letter are never cases; a line counts once per document; documents without a source are left as they are.
"""

from __future__ import annotations

from itertools import count

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsloom.plans.durable import durable, join_counted

#: A line is repeated if it stands in at least so many and at least this share of a source's documents.
LEAST_DOCUMENTS, LEAST_SHARE = 5, 0.2
#: Error of a frequent-items sketch: its estimates lie within ERROR * weight / counters.
ERROR = 3.5
#: Counters of a sketch at least and at most.
FEWEST, MOST = 1024, 65536
#: Confirmed lines are broadcast up to so many rows (two numbers each).
BROADCAST_ROWS = 200_000


def normal_line(line: Column) -> Column:
    """Lower case, outer blanks removed, runs of blanks, tabs and returns as one blank, each run of digits as one digit."""
    return F.lower(F.regexp_replace(F.trim(F.regexp_replace(line, r"[ \t\r]+", " ")), "[0-9]+", "0"))


def hashed(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(key, lines) for each document with a text: an array of the place and a 96-bit hash of the normal form of each line with
    a letter."""
    places = F.filter(F.transform(F.split(text, "\n"), lambda x, i: F.struct(i.alias("line_no"), F.when(x.rlike(r"\p{L}"), normal_line(x)).alias("line"))), lambda x: x["line"].isNotNull())
    lines = F.transform(places, lambda x: F.struct(x["line_no"].alias("line_no"), F.xxhash64(x["line"]).alias("h1"), F.hash(x["line"]).alias("h2")))
    return docs.filter(F.length(text) > 0).select(key, lines.alias("lines"))


def lines_of(docs: DataFrame, sources: DataFrame | None, key: str, source: str, text: str) -> DataFrame:
    """(key, source, line_no, h1, h2) for each line with a letter, and one row with line_no -1 for each document."""
    if sources is None:
        own = docs.withColumn("_nl_key", F.struct(key, source))
        found = hashed(own, "_nl_key", text).select("_nl_key.*", "lines")
    else:
        found = hashed(docs, key, text).join(sources.select(key, source), key)
    mark = F.array(F.struct(F.lit(-1).alias("line_no"), F.lit(0).cast("long").alias("h1"), F.lit(0).alias("h2")))
    return found.filter(F.col(source).isNotNull()).select(key, source, F.inline(F.concat(mark, "lines")))


def candidates(lines: DataFrame, totals: DataFrame, source: str, least: int, share: float) -> DataFrame:
    """(source, h1, upper) of every line that can be repeated, with a bound on the number of its rows.

    totals has the documents (docs) and lines (weight) of each source. A line that stands twice in a document weighs twice
    here, so an estimate never lies below the number of documents. Sources whose documents are so long that no sketch can
    promise to keep every line hand in all their lines.
    """
    need = F.greatest(F.lit(float(FEWEST)), 2 * ERROR / share * F.col("weight") / F.col("docs"))
    counters = F.pow(F.lit(2.0), F.ceil(F.log2(need))).cast("int")
    sized = totals.filter((F.col("docs") >= least) & (F.col("weight") > 0)).select(source, "docs", "weight", F.when(need <= MOST, counters).otherwise(0).alias("counters"))
    kinds = [r[0] for r in sized.select("counters").distinct().collect()]  # powers of two up to MOST, and 0
    total = totals.agg(F.sum("weight")).first()[0] or 0
    each = _joined(lines, sized.select(source, "weight", "docs", "counters"), [source], "weight", total)
    out = each.filter("counters = 0").groupBy(source, "h1").agg(F.count(F.lit(1)).alias("upper"))
    levels = sorted(k for k in kinds if k)
    if levels:
        # each source hands its lines to the sketch of its size; Catalyst merges them on the map side
        sketches = [F.expr(f"approx_top_k_accumulate(h1, {k}) FILTER (WHERE counters = {k})").alias(f"s{k}") for k in levels]
        made = each.filter("counters > 0").groupBy(source).agg(F.first("counters").alias("counters"), F.first("docs").alias("docs"), *sketches)
        items = F.coalesce(*(F.when(F.col("counters") == k, F.expr(f"approx_top_k_estimate(s{k}, {k * 3 // 4})")) for k in levels))
        found = made.select(source, "docs", F.explode(items).alias("i")).select(source, "docs", F.col("i.item").alias("h1"), F.col("i.count").alias("upper"))
        out = out.unionByName(found.filter((F.col("upper") >= F.col("docs") * share) & (F.col("upper") >= least)).drop("docs"))
    return out


def repeated(docs: DataFrame, key: str, source: str, text: str, least: int = LEAST_DOCUMENTS, share: float = LEAST_SHARE, sources: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """The confirmed lines (source, h1, h2, n) and all lines of the documents (see lines_of), both written to the shared folder.

    The source of a document is a column of docs or, by the same key, of sources."""
    marked = durable(lines_of(docs, sources, key, source, text))
    totals = durable(marked.groupBy(source).agg(F.count_if(F.col("line_no") < 0).alias("docs"), F.count_if(F.col("line_no") >= 0).alias("weight")))
    lines = marked.filter("line_no >= 0")
    found = durable(candidates(lines, totals, source, least, share))
    total = found.agg(F.sum("upper")).first()[0] or 0
    checked = _joined(lines, found, [source, "h1"], "upper", total).select(key, source, "h1", "h2").distinct()
    exact = checked.groupBy(source, "h1", "h2").agg(F.count(F.lit(1)).alias("n"))
    confirmed = exact.join(totals, source).filter((F.col("n") >= least) & (F.col("n") >= F.col("docs") * share)).select(source, "h1", "h2", "n")
    return durable(confirmed), lines


def _joined(rows: DataFrame, written: DataFrame, key: list[str], count: str, total: int) -> DataFrame:
    """rows joined with a table of one row per key: broadcast if its counted rows are few, else with its hot keys split."""
    return rows.join(F.broadcast(written), key) if written.count() <= BROADCAST_ROWS else join_counted(rows, written, key, count, total)


def found_lines(docs: DataFrame, key: str, source: str, text: str, **more: object) -> DataFrame:
    """(key, line_no) of each repeated line."""
    confirmed, lines = repeated(docs, key, source, text, **more)
    total = confirmed.agg(F.sum("n")).first()[0] or 0
    return _joined(lines, confirmed, [source, "h1", "h2"], "n", total).select(key, "line_no")


def without_lines(docs: DataFrame, key: str, source: str, text: str, clean: str = "clean", **more: object) -> DataFrame:
    """docs with the text without its repeated lines as `clean`, in place of a column of that name; key must be unique. Texts without
    such lines are not touched."""
    drop = next(n for i in count() if (n := f"_nl_drop{i}") not in docs.columns)
    found = found_lines(docs, key, source, text, **more).groupBy(key).agg(F.collect_set("line_no").alias(drop))
    kept = F.array_join(F.filter(F.split(text, "\n"), lambda _, i: ~F.array_contains(drop, i)), "\n")
    return docs.join(found, key, "left").withColumn(clean, F.when(F.col(drop).isNull(), F.col(text)).otherwise(kept)).drop(drop)
