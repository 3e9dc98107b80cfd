"""Extra columns with the names that operators use inside, nulls in every column, repeated rows and very long texts."""

from pyspark.sql import functions as F

from newsloom.llm import boilerplate, encodings, linkage, mixing, packing, readability, residue

NAMES = (
    "line line_no flat mask message own kind n s p h h1 h2 key lines docs weight upper counters source_id sid pid a df w core attrs box address label header rank start r at range leaf budget epochs rest cap share limit "
    "domain tokens_ units bound part block size _key base each container_id piece_no state fixed _nl_r _nl_drop clean _v _n x y level grade"
).split()


def with_clashes(df):
    return df.select("*", *(F.lit("clash").alias(n) for n in NAMES if n not in df.columns))


def rows_of(df, *columns):
    return sorted(map(str, df.select(*columns).collect()))


def same(make, plain, *columns):
    """The operator gives the same for plain tables and for those with other columns."""
    a, b = make(*plain), make(*(with_clashes(d) for d in plain))
    assert rows_of(a, *columns) == rows_of(b, *columns)
    return a.count()


def test_residue(spark):
    fields = spark.createDataFrame([("1", "body", "Hi {{FNAME}},\nok"), ("1", "body", "Hi {{FNAME}},\nok"), ("2", "body", None), (None, "body", "nginx"), ("3", None, "404 Not Found"), ("4", "body", "nginx"), ("5", "body", "nginx"), ("6", "body", "nginx"), ("7", "body", "1," * 60_000 + " \nnginx")], "msg_id string, field_name string, text string")
    sources = spark.createDataFrame([("4", "a"), ("5", "b"), ("6", "c"), ("7", None), (None, "d")], "msg_id string, source string")
    assert same(residue.residue, (fields, sources), "msg_id", "field_name", "kinds") == 6


def test_boilerplate(spark):
    docs = spark.createDataFrame([(f"m{i}", "s" if i else None, "Same line\nown " + "abcdefghij"[i % 10] * (i + 1)) for i in range(12)] + [("n", "s", None), (None, "s", "Same line")], "id string, source string, text string")
    assert same(lambda d: boilerplate.found_lines(d, "id", "source", "text"), (docs,), "id", "line_no") == 12
    assert boilerplate.without_lines(with_clashes(docs), "id", "source", "text").count() == 14


def test_linkage(spark):
    tracker = spark.createDataFrame([(1, "Amber Abacus", None, None, None), (None, None, None, None, None)], "source_id bigint, newsletter_name string, publisher string, signup_url string, subscribe_email string")
    mail = spark.createDataFrame([("m1", "Amber Abacus <a@b.example>", None, None), ("m1", "Amber Abacus <a@b.example>", None, None), ("m2", None, None, None), (None, "x", None, None), ("m3", "Amber Abacus" + " x" * 20_000 + " <l@b.example>", None, None)], "msg_id string, from_h string, to_h string, delivered_to string")
    assert same(lambda m, t: linkage.link(m, t), (mail, tracker), "source_id", "msg_id") == 1


def test_packing(spark):
    items, kinds = spark.createDataFrame([(1, 5), (2, 50), (2, 50), (3, None), (None, 7)], "id int, tokens int"), spark.createDataFrame([("k", 20), ("z", None), (None, 30)], "container_kind string, capacity_tokens int")
    assert same(lambda i, k: packing.pack(i, k, "id"), (items, kinds.filter("container_kind IS NOT NULL")), "container_kind", "id", "tokens") == 8
    assert packing.fill(packing.pack(items, kinds.limit(1), "id"), with_clashes(kinds.limit(1)).withColumn("tokens", F.lit(1)).withColumn("containers", F.lit(2))).count() == 1


def test_mixing(spark):
    sized = spark.createDataFrame([(1, "a", "en", "g", 5), (1, "a", "en", "g", 5), (2, "a", None, None, 7), (3, None, "en", "g", 9), (4, "b", "de", "g", None), (None, "b", "de", "g", 3)], "doc_id int, source string, lang string, segment string, tokens int")
    targets = spark.createDataFrame([("a", 0.5, 2), ("b", 0.5, 1), ("a", 0.5, 2), (None, 0.1, 1), ("c", None, None)], "source string, target_share double, max_repeats int")
    assert same(lambda s, t: mixing.mix(s, t)[0], (sized, targets), "doc_id", "source", "tokens", "times") > 0


def test_readability(spark):
    docs = spark.createDataFrame([(i, f"the dog ran to a big house {'notwithstanding ' * (i % 5)}and sat.", "s" if i % 2 else None) for i in range(60)] + [(99, None, "s"), (98, "", None), (97, "word " * 200_000, "s")], "doc_id int, text string, source string")
    labels = spark.createDataFrame([(i, 1 + i % 5) for i in range(60)] + [(1, None), (None, 3), (5, 1)], "doc_id int, reading_level int")
    assert same(lambda d, x: readability.levels(d, x), (docs, labels), "doc_id", "level") == 61


def test_encodings(spark):
    df = with_clashes(spark.createDataFrame([(1, "caf\u00c3\u00a9"), (1, "caf\u00c3\u00a9"), (2, None)], "id int, t string"))
    assert encodings.garbled_rows(df, "t").count() == 2 and {r.fixed for r in encodings.with_restored(df, "t").collect()} == {"café", None}
