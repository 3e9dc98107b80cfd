"""The queries of the subpackage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newsloom.llm import boilerplate, encodings, linkage, mixing, packing, readability, residue, tokens
from newsloom.sources.tables import canonical_id, sender_address, table


def fields(spark: SparkSession, at: str) -> tuple[DataFrame, DataFrame]:
    """The subjects of all deliveries and the bodies, each as (msg_id, field_name, text)."""
    subjects = table(spark, at, "message_summary").select(canonical_id("msg_id").alias("msg_id"), F.lit("subject").alias("field_name"), F.col("subject").alias("text"))
    bodies = table(spark, at, "full_message").select(canonical_id("msg_id").alias("msg_id"), F.lit("body").alias("field_name"), F.col("body").alias("text"))
    return subjects, bodies


def p2_found(spark: SparkSession, at: str) -> DataFrame:
    subjects, bodies = fields(spark, at)
    found = [encodings.garbled_rows(x, "text").select("msg_id", "field_name") for x in (subjects, bodies)]
    return found[0].filter(F.col("msg_id").isNotNull()).distinct().unionByName(found[1].filter(F.col("msg_id").isNotNull()).distinct())


def p2_restored(spark: SparkSession, at: str) -> DataFrame:
    """The affected fields with their original text, as far as it could be restored."""
    parts = []
    for x in fields(spark, at):
        fixed = encodings.with_restored(x.filter(F.col("text").rlike(encodings.SUSPECT)), "text").filter("state <> 'clean' AND msg_id IS NOT NULL")
        # of several deliveries the one that could be restored counts, not one that had lost characters
        best = F.min(F.struct((F.col("state") != "restored").alias("worse"), "state", "fixed"))
        parts.append(fixed.groupBy("msg_id", "field_name").agg(best.alias("r")).select("msg_id", "field_name", "r.state", "r.fixed"))
    return parts[0].unionByName(parts[1])


def senders(spark: SparkSession, at: str) -> DataFrame:
    """The sender of each message; deliveries of one message have the same."""
    rows = table(spark, at, "message_summary").select(canonical_id("msg_id").alias("msg_id"), sender_address("from_h").alias("source"))
    return rows.filter("msg_id IS NOT NULL").groupBy("msg_id").agg(F.min("source").alias("source"))


def p3_residue(spark: SparkSession, at: str) -> DataFrame:
    subjects, bodies = fields(spark, at)
    return residue.residue(subjects.unionByName(bodies).filter("msg_id IS NOT NULL"), senders(spark, at))


def p3_found(spark: SparkSession, at: str) -> DataFrame:
    return p3_residue(spark, at).select("msg_id", "field_name")


def p3_clean(spark: SparkSession, at: str) -> DataFrame:
    """The bodies that remain when fields with residue are excluded."""
    bad = p3_found(spark, at).filter("field_name = 'body'").select("msg_id")
    return table(spark, at, "full_message").select(canonical_id("msg_id").alias("msg_id"), F.length("body").alias("n_chars")).join(bad, "msg_id", "left_anti")


def bodies_with_text(spark: SparkSession, at: str) -> DataFrame:
    return table(spark, at, "full_message").select(canonical_id("msg_id").alias("msg_id"), "body").filter(F.length("body") > 0)


def p6_found(spark: SparkSession, at: str) -> DataFrame:
    found = boilerplate.found_lines(bodies_with_text(spark, at), "msg_id", "source", "body", sources=senders(spark, at))
    return found.select("msg_id", F.col("line_no").cast("int").alias("line_no"))


def p6_clean(spark: SparkSession, at: str) -> DataFrame:
    """The bodies without their repeated lines; those without a summary have no source and stay as they are."""
    clean = boilerplate.without_lines(bodies_with_text(spark, at), "msg_id", "source", "body", sources=senders(spark, at))
    return clean.select("msg_id", F.sha2("clean", 256).alias("clean_hash"), F.length("clean").cast("long").alias("n_chars"))


def p1_linked(spark: SparkSession, at: str) -> DataFrame:
    """The tracker row of each message, with a confidence."""
    messages = table(spark, at, "message_summary").select(canonical_id("msg_id").alias("msg_id"), "from_h", "to_h", "delivered_to").filter("msg_id IS NOT NULL")
    return linkage.link(messages, table(spark, at, "sources")).withColumn("confidence", F.round("confidence", 4))


def p1_found(spark: SparkSession, at: str) -> DataFrame:
    return p1_linked(spark, at).select("source_id", "msg_id")


def p7_packed(spark: SparkSession, at: str) -> DataFrame:
    sized = tokens.sized(table(spark, at, "documents"), "doc_id", "text")
    return packing.pack(sized, table(spark, at, "containers"), "doc_id")


def p7_fill(spark: SparkSession, at: str) -> DataFrame:
    return packing.fill(p7_packed(spark, at), table(spark, at, "containers"))


def _mix(spark: SparkSession, at: str) -> tuple[DataFrame, DataFrame]:
    sized = tokens.sized(table(spark, at, "documents"), "doc_id", "text", ("source", "lang", "segment"))
    return mixing.mix(sized, table(spark, at, "mix_targets"))


def p8_mixed(spark: SparkSession, at: str) -> DataFrame:
    return _mix(spark, at)[0]


def p8_shares(spark: SparkSession, at: str) -> DataFrame:
    return mixing.report(*_mix(spark, at), table(spark, at, "mix_targets"))


def p8_leaves(spark: SparkSession, at: str) -> DataFrame:
    """The leaves of the tree with their budgets; null domains and languages are branches."""
    name = lambda c: F.nullif(c, F.lit(mixing.NONE)).alias(c)
    return _mix(spark, at)[1].select("source", name("domain"), name("lang"), F.round("weight", 9).alias("weight"), "cap", F.col("rows").alias("records"), "tokens", "budget", "epochs", "rest")


def p9_levels(spark: SparkSession, at: str) -> DataFrame:
    return readability.levels(table(spark, at, "documents"), table(spark, at, "reading_labels")).withColumn("level", F.round("level", 3))


def p9_found(spark: SparkSession, at: str) -> DataFrame:
    graded = readability.levels(table(spark, at, "documents"), table(spark, at, "reading_labels"))
    return graded.filter(F.col("level") >= readability.DEMANDING).select("doc_id")


def p9_profile(spark: SparkSession, at: str) -> DataFrame:
    """How demanding each source is."""
    graded = readability.levels(table(spark, at, "documents"), table(spark, at, "reading_labels"))
    return graded.groupBy("source").agg(F.count(F.lit(1)).alias("documents"), F.round(F.avg("level"), 3).alias("mean_level"), F.count_if(F.col("level") >= readability.DEMANDING).alias("demanding"))


def p9_held_out(spark: SparkSession, at: str) -> DataFrame:
    """How well grades meet the labels of sources that neither the trees nor their calibration have seen, by source."""
    return readability.held_out(table(spark, at, "documents"), table(spark, at, "reading_labels"))


QUERIES = {"p1_found": p1_found, "p1_linked": p1_linked, "p2_found": p2_found, "p2_restored": p2_restored, "p3_found": p3_found, "p3_residue": p3_residue, "p3_clean": p3_clean, "p6_found": p6_found, "p6_clean": p6_clean, "p7_packed": p7_packed, "p7_fill": p7_fill, "p8_mixed": p8_mixed, "p8_shares": p8_shares, "p8_leaves": p8_leaves, "p9_found": p9_found, "p9_levels": p9_levels, "p9_profile": p9_profile, "p9_held_out": p9_held_out}

_SENDERS = r"""(SELECT lower(regexp_replace(msg_id, '\s+', '', 'g')) AS msg_id,
    min(regexp_replace(lower(trim(CASE WHEN regexp_extract(from_h, '<([^<>]*)>\s*$', 1) <> '' THEN regexp_extract(from_h, '<([^<>]*)>\s*$', 1) ELSE from_h END)), '\+[^@]*@', '@')) AS source
    FROM message_summary GROUP BY 1)"""
_LINES = rf"""bodies AS (SELECT f.msg_id, s.source, f.body FROM full_message f JOIN {_SENDERS} s USING (msg_id) WHERE length(f.body) > 0),
    sizes AS (SELECT source, count(*) AS docs FROM bodies GROUP BY source),
    lines AS (SELECT msg_id, source, unnest(string_split(body, chr(10))) AS line, unnest(range(len(string_split(body, chr(10))))) AS line_no FROM bodies),
    norm AS (SELECT msg_id, source, line_no, lower(regexp_replace(trim(regexp_replace(line, '[ \t\r]+', ' ', 'g')), '[0-9]+', '0', 'g')) AS line FROM lines WHERE regexp_matches(line, '\p{{L}}')),
    hits AS (SELECT source, line FROM norm JOIN sizes USING (source) GROUP BY source, line, docs HAVING count(DISTINCT msg_id) >= 5 AND count(DISTINCT msg_id) >= 0.2 * docs)"""
ORACLE: dict[str, str] = {
    "p6_found": f"WITH {_LINES} SELECT msg_id, CAST(line_no AS INT) AS line_no FROM norm SEMI JOIN hits USING (source, line)",
    "p6_clean": f"""WITH {_LINES}, gone AS (SELECT msg_id, list(line_no) AS g FROM norm SEMI JOIN hits USING (source, line) GROUP BY msg_id),
        kept AS (SELECT f.msg_id, CASE WHEN g IS NULL THEN body ELSE coalesce(array_to_string(list_transform(list_filter(range(len(string_split(body, chr(10)))), lambda i: NOT list_contains(g, i)), lambda i: string_split(body, chr(10))[i + 1]), chr(10)), '') END AS clean
            FROM full_message f LEFT JOIN gone USING (msg_id) WHERE length(body) > 0)
        SELECT msg_id, sha256(clean) AS clean_hash, CAST(length(clean) AS BIGINT) AS n_chars FROM kept""",
}

