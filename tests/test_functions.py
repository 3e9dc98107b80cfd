"""Column functions, readers and sinks."""

import json

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from newsloom.functions import dates, html, text, urls
from newsloom.sources import mime, readers, sinks


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


def test_headers(spark):
    raw = "Subject:\nFrom: =?UTF-8?B?w4k=?= <A@B.example>\nX: a\n b\n\nTo: body"
    block = text.header_block(F.lit(raw))
    assert one(spark, text.header(block, "Subject")) == "" and one(spark, text.header(block, "X")) == "a b" and one(spark, text.header(block, "To")) == ""
    assert one(spark, text.plus_tag(F.lit("Box+TechAI@x.example"))) == "techai" and one(spark, text.plus_tag(F.lit("box@x.example"))) is None
    assert one(spark, mime.decode_words(F.lit("=?utf-8?Q?caf=C3=A9?= =?iso-8859-1?B?6Q==?="))) == "caféé" and one(spark, mime.decode_words(F.lit("=?x?Z?broken"))) == "=?x?Z?broken"
    assert one(spark, text.encode_header_word(F.lit("é"))) == "=?UTF-8?B?w6k=?=" and one(spark, text.encode_header_word(F.lit("e"))) == "e"
    assert one(spark, text.mime_type(F.lit("a.PDF"))) == "application/pdf" and one(spark, text.mime_type(F.lit("a"))) == "application/octet-stream"
    assert one(spark, text.insert_after(F.lit("a[m]b[m]"), "[m]", "X")) == "a[m]Xb[m]" and one(spark, text.insert_after(F.lit("ab"), "[m]", "X")) == "abX"
    assert one(spark, text.strip_cells(F.lit(4), F.array(F.lit(1), F.lit(3)))) == "■□■□" and one(spark, text.safe_file_name(F.lit('a/b:"c"'))) == "a_b__c_"
    assert one(spark, text.split_list(F.lit(" a, ,b "))) == ["a", "b"]
    assert one(spark, text.number_value(F.lit("$1,081.5B"))) == 1081.5e9 and one(spark, text.number_unit(F.lit("120 bps"))) == "bps"


@settings(max_examples=20, deadline=None)
@given(st.lists(st.text(st.characters(blacklist_categories=["Cs"], blacklist_characters="\0"), max_size=60), min_size=1, max_size=20))
def test_round_trips(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for r in df.select("t", text.from_base64url(text.to_base64url(F.col("t"))).alias("b"), text.slug(F.col("t")).alias("s"), text.slug(text.slug(F.col("t"))).alias("ss"), urls.canonical(F.col("t")).alias("u"), urls.canonical(urls.canonical(F.col("t"))).alias("uu")).collect():
        assert r.b == r.t and len(r.s) <= 28 and (r.ss.rstrip("-") == r.s.rstrip("-") or r.s == "")
        assert r.u == r.uu or "?" in r.t or "#" in r.t or " " in r.t or not r.t.isascii() or not r.t.isprintable() or r.t != r.t.strip()


def test_urls(spark):
    assert one(spark, urls.canonical(F.lit("https://A.example/P/?utm_x=1&b=2&a=1#f"))) == "https://a.example/P?a=1&b=2"
    assert one(spark, urls.channel_url(F.lit("@x"))).endswith("/@x") and one(spark, urls.video_url(F.lit("abc"))).endswith("v=abc")
    assert one(spark, urls.host(F.lit("https://www.A.example:8/x"))) == "a.example"


def test_dates(spark):
    check = lambda d, f: str(one(spark, dates.next_check(dates.to_date_or_null(F.lit(d)), F.lit(f))))
    assert [check("2030-01-01", f) for f in ("daily", "weekly", "biweekly", "3x-weekly", "monthly", "2x-weekly")] == ["2030-01-04", "2030-01-10", "2030-01-17", "2030-01-06", "2030-02-02", "2030-01-10"]
    assert check("bad", "daily") == "None"
    assert one(spark, dates.cue_seconds(F.lit("01:00:03.250"))) == 3603.25 and one(spark, dates.is_all_day(F.lit("2025-01-01"))) is True


def test_html():
    page = "<h1>T</h1><script>x</script><ul><li>a<ul><li>b</li></ul></li></ul><table><tr><td>1</td><td><table><tr><td>2</td></tr></table></td></tr></table><p>go <a href='u'>there</a> <b>now</b></p>"
    out = html.markdown_of(page)
    assert out.startswith("# T") and "- a" in out and "- b" in out and "[there](u)" in out and "**now**" in out and "| 2" in out and "x" not in out.split("\n")
    assert html.markdown_of(None) is None and html.markdown_of("") == ""


def test_html_columns(spark):
    assert one(spark, html.plain_text(F.lit("<p>a &amp; b</p><style>c</style><!-- d -->e"))) == "a & b e"
    assert one(spark, html.without_pixels(F.lit('a<img src="t" width="1" height="1">b'))) == "ab"
    assert one(spark, html.body_or_html(F.lit(" "), F.lit("<b>x</b>"))) == "x"


MAIL = b'From: "Ann" <a@b.example>\r\nSubject: =?UTF-8?B?w4k=?=\r\nMIME-Version: 1.0\r\nContent-Type: multipart/mixed; boundary=o\r\n\r\n--o\r\nContent-Type: text/plain\r\n\r\nouter\r\n--o\r\nContent-Type: multipart/alternative; boundary=i\r\n\r\n--i\r\nContent-Type: text/plain; charset=utf-8\r\n\r\ninner\r\n--i\r\nContent-Type: text/html\r\n\r\n<p>h</p>\r\n--i--\r\n--o\r\nContent-Type: text/plain\r\nContent-Disposition: attachment; filename=f.txt\r\n\r\nfile\r\n--o--\r\n'


def test_mail_folder(spark, tmp_path):
    for i in range(5):
        (tmp_path / f"m{i}.eml").write_bytes(MAIL if i else b"x")
    files = readers.eml_folder(spark, str(tmp_path))
    assert files.count() == 5 and files.filter("msg_id = 'm1'").first().raw == MAIL
    box = readers.mailbox(spark, str(tmp_path), page=2)
    assert box.count() == 5 and box.filter("msg_id = 'm3'").count() == 1 and box.filter("msg_id = 'none'").count() == 0
    got = mime.parse_messages(files).filter("msg_id = 'm2'").first()
    assert got.subject == "É" and got.body.strip() == "inner" and got.html_body.strip() == "<p>h</p>" and got.attachments == 1
    assert mime.parsed(None) == (None,) * 9


def test_rules_and_lines(spark, tmp_path):
    (tmp_path / "rules.xml").write_text("""<feed xmlns:apps="a"><entry><id>1</id><apps:property name='from' value='x@y.example'/><apps:property name='label' value='L'/></entry><entry><id>2</id><apps:property name='hasTheWord' value='deliveredto:z'/><apps:property name='label' value='M'/></entry></feed>""")
    assert [tuple(r) for r in readers.filter_rules(spark, str(tmp_path / "rules.xml")).orderBy("rule_id").collect()] == [("1", "from", "x@y.example", "L"), ("2", "hasTheWord", "deliveredto:z", "M")]
    (tmp_path / "e.jsonl").write_text('{"a": 1}\n\n{"a": \nnope\n{"a": 2}\n')
    assert sorted(r.a for r in readers.json_lines(spark, str(tmp_path / "e.jsonl"), "a int").collect()) == [1, 2]
    (tmp_path / "t.csv").write_text('segment,newsletter_name\n1-TechAI,"a ""b""\nc"\n')
    assert readers.csv_table(spark, str(tmp_path / "t.csv"), "segment string, newsletter_name string").first().newsletter_name == 'a "b"\nc'


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([(1, 'a "q"\nb', "s1", "2025-01-01"), (2, None, "s2", "2025-01-02")], "id int, t string, segment string, received_date string")
    sinks.write_csv(df, str(tmp_path / "csv"))
    text_out = "".join(p.read_text() for p in (tmp_path / "csv").glob("*.csv"))
    assert '"1","a ""q"" b","s1","2025-01-01"' in text_out
    sinks.write_json(df, str(tmp_path / "json"))
    assert sorted(json.loads(x)["id"] for p in (tmp_path / "json").glob("*.json") for x in p.read_text().splitlines()) == [1, 2]
    sinks.write_archive(df, str(tmp_path / "arc"))
    assert (tmp_path / "arc" / "segment=s1" / "received_date=2025-01-01").exists()
    at = str(tmp_path / "table")
    assert sinks.append_new(df, at, "id") == 2 and sinks.append_new(df.unionByName(df), at, "id") == 0
    sinks.replace_table(spark.read.parquet(at).filter("id = 1"), at)
    assert spark.read.parquet(at).count() == 1
    assert df.select(sinks.blob_path("segment", "t", "id")).first()[0] == "eml/s1/a-q-b__1.eml"


def test_markdown_to_html(spark):
    assert html.html_of("# T & x\n\n- a **b**\n- [c](https://d.example)\n\n1. z\ntext `q`") == '<h1>T &amp; x</h1>\n<ul>\n<li>a <strong>b</strong></li>\n<li><a href="https://d.example">c</a></li>\n</ul>\n<ol>\n<li>z</li>\n</ol>\n<p>text <code>q</code></p>'
    assert html.html_of(None) is None and html.html_of("") == "" and one(spark, html.from_markdown(F.lit("*i*"))) == "<p><em>i</em></p>"
    assert one(spark, text.cells_text(F.array(F.array(F.lit("a"), F.lit("b")), F.array(F.lit("c"))))) == "a\tb\nc"


def test_movers_and_topics_of_every_form(spark):
    from newsloom.functions import text as t

    line = "Calix soars 12%, Amber Corp falls 3.5% after weak sales; S&P 500 −0.74% | HPE +7% | Oil ▼ 1.5%; Dow (-2%)"
    rows = spark.createDataFrame([(line,), ("rates at 5% and 10-20%",)], "s string").select(t.movers(F.col("s")).alias("m")).collect()
    assert [tuple(x) for x in rows[0].m] == [("Calix", 12.0, "up", None), ("Amber Corp", -3.5, "down", "weak sales"), ("S&P 500", -0.74, "down", None), ("HPE", 7.0, "up", None), ("Oil", -1.5, "down", None), ("Dow", -2.0, "down", None)]
    assert rows[1].m == []
    subjects = ["Plus! a; b", "Import AI 474: x y; z; and w", "a, b, c", "Phone 📱, rocket 🚀, lab 🧪", "Phone 📱 rocket 🚀 lab 🧪", "Hello, you", "$1,000 for a"]
    topics = [r.t for r in spark.createDataFrame([(x,) for x in subjects], "s string").select(t.listed_topics(F.col("s")).alias("t")).collect()]
    assert topics == [["a", "b"], ["x y", "z", "w"], ["a", "b", "c"], ["Phone", "rocket", "lab"], ["Phone", "rocket", "lab"], [], []]
