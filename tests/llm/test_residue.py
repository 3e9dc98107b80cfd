"""Template residue and error pages: cases, decoys, recurrence."""

import re

import pytest
from pyspark.sql import functions as F

from newsloom.llm import residue as R

CASES = [
    "Dear {{first_name}},", "Hi {FNAME},", "Hola ${Vorname}:", "#{company} edition", "*|FNAME|*, hello", "Hi %%PRENOM%%", "%(headline)s, now", "@@issue_date@@ edition", "##CITY##, hi", "https://x.example/$first_name$/read", "<<reader_name>>", "«first_name»: news", "__Vorname__,", "[[company]]", "Dear [first_name],", "[INSERT SPONSOR COPY HERE]",
    "{% if vip %}x{% endif %}", "{% for story in stories %}", "<%= user.first %>", "<!-- drop the ad block in here -->", "Sale [object Object]", "Dear null,", "undefined: The week", "Today's number: undefined", "Weather: NaN°", "Hi  , your issue for  is ready, null null.", "A week TKTK", "TK TK TK – headline to come",
    "Your NaN stories for undefined", "Headline goes here", "Insert subject here (max 50 chars)", "Copy of Copy of TEMPLATE – do not send", "XX placeholder subject XX", "[SUBJECT LINE TK]", "Texte de remplacement", "Your caption here", "Hier steht Ihr Text.", "Body text goes here. Replace this paragraph before sending.",
    "Story 3 headline (60 characters max)", "This block is left blank for the editor to fill in.", "Lorem ipsum aliqua pariatur enim minim.", "Tempor velit quis nunc fugiat nisi ut pariatur amet.", "Please enable JavaScript to view this email.\r", "Your browser has scripts switched off.", "404 Not Found", "Error 404 – Page not found", "502 Bad Gateway", "Access denied",
    "Service temporarily unavailable", "Bitte JavaScript aktivieren", "Page introuvable (404)", "Session expired – sign in again", "Something went wrong. Try again later.", "Uncaught TypeError: cannot read properties of undefined (reading 'title')", "Fatal error: template not found in render() on line 7", "Checking your browser before you continue…",
    "Der Server ist derzeit nicht erreichbar (Fehler 23).", "Cette page n’existe plus ou a été déplacée.", "Error 76823: origin unreachable", "Prove that you are human to go on.",
]
DECOYS = [
    "Designers at X still paste lorem ipsum into every draft, a survey found.", "In the code sample, `${total}` prints the sum and `%s` prints the name.", "The bill sets a [first] and a [second] test for X.", "The team explains why `{{ name }}` stays in the template until send time.", "Readers met a “404 Not Found” page when X moved its store.",
    "The memo said “please enable JavaScript”, which the judge called a poor excuse.", "A new tool lets sites run when JavaScript is off; X tested it.", "Placeholder kings of X", "Null and void: X loses its appeal", "100% off? %-signs that fooled X", "JavaScript is required reading this week", "Access denied: a court closes the archive", "Undefined behaviour, defined",
    "Why everyone fights over `{{ }}` in templates", "The 404 economy: dead pages, live money", "[Podcast] First names on the shop floor", "Gateway drug: how 502 shops got hooked on credit", "Lorem ipsum is over: designers want real copy", "[March] a security patch", "View this issue in your browser", "Markets are closed today.", "about $12 million and $40 million", "nginx", "",
]


def found(spark, texts, sources=None):
    fields = spark.createDataFrame([(str(i), "body", t) for i, t in enumerate(texts)], "msg_id string, field_name string, text string")
    who = spark.createDataFrame([(str(i), (sources or ["a"] * len(texts))[i]) for i in range(len(texts))], "msg_id string, source string")
    return {int(r.msg_id) for r in R.residue(fields, who).collect()}


def test_cases_and_decoys(spark):
    got = found(spark, CASES + DECOYS)
    assert [CASES[i] for i in range(len(CASES)) if i not in got] == []
    assert [DECOYS[i - len(CASES)] for i in sorted(got) if i >= len(CASES)] == []


def test_general_phrases_need_sources(spark):
    assert found(spark, ["x\nRay 12", "Ray 7\ny", "Ray 8"], ["a", "b", "c"]) == {0, 1, 2}
    assert found(spark, ["Ray 12", "Ray 7", "Ray 8"], ["a", "a", "b"]) == set()


def test_whole_texts_and_nulls(spark):
    long = "fine words here again. " * 20_000
    assert found(spark, [None, "", long, long + "\nHi {{FNAME}},\n" + long]) == {3}
    assert found(spark, [None]) == set()


@pytest.mark.parametrize("line", ["Hello {{name}} and `{{name}}`"])
def test_code_quotes_hide_only_their_own(spark, line):
    assert found(spark, [line]) == {0}


def samples(parsed):
    """Texts of a parsed rule that take each of its branches at least once."""
    parts = []
    for op, arg in parsed:
        op = str(op)
        if op == "LITERAL":
            parts.append([chr(arg)])
        elif op == "IN":
            by = {"LITERAL": lambda x: chr(x), "RANGE": lambda x: chr(x[0]), "CATEGORY": lambda x: {"CATEGORY_SPACE": " ", "CATEGORY_NOT_WORD": "!"}.get(str(x), "a"), "NEGATE": lambda x: "-"}
            parts.append([by[str(arg[0][0])](arg[0][1])] if str(arg[0][0]) == "NEGATE" else [by[str(k)](x) for k, x in arg])
        elif op == "SUBPATTERN":
            parts.append(samples(arg[3]))
        elif op == "BRANCH":
            parts.append([t for x in arg[1] for t in samples(x)])
        elif op in ("MAX_REPEAT", "MIN_REPEAT"):
            parts.append(([""] if arg[0] == 0 else []) + [t * max(1, arg[0]) for t in samples(arg[2])])
        else:
            parts.append(["a"] if op in ("ANY", "NOT_LITERAL") else [""])
    return ["".join([*(p[-1] for p in parts[:i]), t, *(p[-1] for p in parts[i + 1 :])]) for i, p in enumerate(parts) for t in p] or [""]


def test_guards_drop_no_line_that_a_rule_matches(spark):
    rules = [*R.PLACEHOLDERS, *R.FAILED, *R.FILLER, *R.SURE, *R.GENERAL]
    each = [[t for t in samples(re._parser.parse(r)) if re.search(r, t, re.IGNORECASE)] for r in rules]
    assert [r for r, t in zip(rules, each, strict=True) if not t] == []
    texts = {t for x in each for t in x if "\n" not in t}
    texts |= {t.upper() for t in texts} | {t.replace(" ", " \t ") for t in texts}
    words = R.LATIN.split()
    texts |= {f"{w} {v}, {w}. {w}" for w, v in zip(words, reversed(words), strict=True)} | {f"{w} 12 {v}\tHouses {w}" for w, v in zip(words, words[3:], strict=False)}
    lines = spark.createDataFrame([(t,) for t in sorted(texts)], "line string").withColumn("flat", R.plain(F.col("line"))).withColumn("mask", R.masked(F.col("flat")))
    flat, mask = F.col("flat"), F.col("mask")
    whole = flat.rlike(R._PLACE) | mask.rlike("(?i)" + "|".join((*R.FAILED, *R.FILLER))) | (R._latin_share(mask) >= R.LATIN_SHARE) | mask.rlike(R._SURE)
    rows = lines.select("line", whole.alias("whole"), R.own_kind(flat, mask).isNotNull().alias("own"), R.wide_kind(flat, mask).isNotNull().alias("wide"), mask.rlike(R._GENERAL).alias("general")).collect()
    assert sum(r.whole for r in rows) > 1000
    assert [r.line for r in rows if r.whole != r.own] == []
    assert [r.line for r in rows if (r.whole or r.general) and not r.wide] == []


def test_lines_without_a_listed_word(spark):
    lines = ["Dolor irure enim irure sint velit.", "Hi None,", "Hello None!", "Test email", "Please enable cookies.", "The page could not be found", "The page does not exist.", "Fehler 404 - Seite nicht gefunden", "Script is disabled", "Hola $prénom$, hi", "502 Bad \t Gateway", "NONE"]
    assert found(spark, lines) == set(range(len(lines)))


UNLISTED = ["Scripts must be allowed before this letter can appear.", "<<First Name goes here please>>", "Ihre Sitzung konnte nicht erneuert werden, Zugriff verweigert.", "Put your teaser text here before sending", "{Anrede des Empfängers}", "«your first name goes here»", "Platzhalter: Überschrift", "La connexion au serveur a échoué."]
ORDINARY = ["View this issue in your browser", "Trouble viewing? Read it in your browser with images enabled", "Access denied: a court closes the archive", "JavaScript is required reading this week", "Read the full text here", "[March] a security patch", "« La forêt gagnée »", "Please confirm your address", "Markets are closed today.", "100% off and 20% more", "Unsubscribe | Manage preferences | Contact"]


def test_recurrence_finds_what_no_list_names(spark):
    texts = [f"Edition {i}\n{t}" for t in UNLISTED + ORDINARY for i in range(60)]
    where = [f"s{i % 20}" for _ in UNLISTED + ORDINARY for i in range(60)]
    got = found(spark, texts, where)
    assert {i // 60 for i in got} == set(range(len(UNLISTED)))
    assert len(got) == 60 * len(UNLISTED)
    assert found(spark, texts, ["one"] * len(texts)) == set()


def test_placeholders_of_any_length(spark):
    assert found(spark, ["Hi {{ " + "customer.profile." * 20 + "name }},", "{% if " + "a and " * 50 + "b %}", "[Insert " + "very " * 60 + "long copy]", "*|" + "X" * 90 + "|*", "[" + "word " * 30 + "TK]"]) == {0, 1, 2, 3, 4}


def test_a_hot_message_and_unknown_sources(spark):
    fields = spark.createDataFrame([(str(i), "body", "one more step\n" * 3 if i % 3 == 0 else f"own {i}") for i in range(300)], "msg_id string, field_name string, text string")
    who = spark.createDataFrame([(str(i), f"s{i % 9}") for i in range(300)], "msg_id string, source string")
    assert {int(r.msg_id) for r in R.residue(fields, who).collect()} == set(range(0, 300, 3))
    assert R.residue(fields, who.withColumn("source", F.lit(None).cast("string"))).count() == 0
    assert R.residue(fields.limit(0), who).count() == 0
