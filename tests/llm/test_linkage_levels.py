"""Linkage and reading levels: small worlds with known answers, held-out accuracy."""

import random

import numpy as np

from newsloom.llm import linkage as K
from newsloom.llm import readability as R

TRACKER = "source_id bigint, newsletter_name string, publisher string, signup_url string, subscribe_email string"
MAIL = "msg_id string, from_h string, to_h string, delivered_to string, source_id string"


def world():
    tracker = [
        (1, "Amber Abacus (ex-Granite Telescope)", "Calix Press", None, "box+biz@in.example"), (2, "Orbel Health", "Orbel Media LLC", "https://orbel.example/s", "box+hr@in.example"), (3, "Orbel Markets Newsletter", "Orbel Media", "https://orbel.example/s", "box+biz@in.example"),
        (4, "Copper Ledger", None, None, "box+law@in.example"), (5, "Größe Drei", "Kag News", "https://getgrosedrei.example/s", None), (6, None, None, None, None),
    ]
    mail, truth = [], {}

    def add(n, source, who, to="box+biz@in.example"):
        for _ in range(n):
            m = f"m{len(mail)}"
            mail.append((m, who, to, None, "clash"))
            if source:
                truth[m] = source

    add(9, 1, "Amber Abacus <em7@hop.example>"), add(5, 1, '"Granite Telescope" <em7@hop.example>'), add(2, 1, "AA <em7@hop.example>"), add(2, 1, "Ambr Abacus <em7+x@hop.example>"), add(1, 1, "em7@hop.example")
    add(6, 2, "Orbel Health <news@orbel.example>", "box+hr@in.example"), add(6, 3, "Markets at Orbel <news@orbel.example>"), add(3, 3, "Orbel Media <news@orbel.example>"), add(3, 2, "Orbel <news@orbel.example>", "Reader <BOX+HR@in.example>"), add(1, 2, "Orbel Heatlh <news@orbel.example>", "box@in.example")
    add(7, None, "Orbel Travel | Orbel Media LLC <travel@orbel.example>"), add(2, None, "Orbel Travel <news@orbel.example>")
    add(8, None, "Copper Ledge <hello@copperledge.example>", "box+law@in.example"), add(8, 4, '"Ledger, Copper" <x@y.example>', "box+law@in.example")
    add(5, 5, "=?UTF-8?B?R3LDtsOfZSBEcmVp?= <news@getgrosedrei.example>"), add(4, None, "Shop <no-reply@z.example>"), add(1, None, None), add(1, None, "")
    return tracker, mail, truth


def test_links(spark):
    tracker, mail, truth = world()
    got = {r.msg_id: r.source_id for r in K.link(spark.createDataFrame(mail + mail[:5], MAIL), spark.createDataFrame(tracker, TRACKER)).collect()}
    assert got == truth


def test_all_header_forms_of_a_profile_count(spark):
    tracker = spark.createDataFrame([(1, "Amber Abacus", "Calix Press", None, None)], TRACKER)
    who = [f"Ambr Abacus{end} <em{i}@hop{i}.example>" for i in range(24) for end in ("", " | Calix Press", " | Tordoter News Co.")]
    links = []
    for order in (who, who[::-1]):
        mail = spark.createDataFrame([(w, w, "box+biz@in.example", None, "clash") for w in order], MAIL)
        links.append({(r.msg_id, r.source_id, round(r.confidence, 9)) for r in K.link(mail, tracker).collect()})
    assert links[0] == links[1] and {m for m, _, _ in links[0]} == set(who)


def test_long_names_one_letter_off():
    name = "amber" * 30
    for n in (40, 41, 42, 150):
        whole, gone = name[:n], name[: n // 2] + name[n // 2 + 1 : n]
        assert K._deletions(whole) & K._deletions(gone) and K._deletions(whole) & K._deletions(whole[:3] + "x" + whole[4:])
        assert not K._deletions(whole) & K._deletions("zebra" * 30)
    assert len(K._deletions("amberx" * 5000)) == 30_001


def test_partitions_change_nothing(spark):
    tracker, mail, truth = world()
    results = []
    for parts in (1, 7):
        got = K.link(spark.createDataFrame(mail, MAIL).repartition(parts, "msg_id"), spark.createDataFrame(tracker, TRACKER).repartition(parts)).collect()
        results.append({(r.msg_id, r.source_id, round(r.confidence, 9)) for r in got})
    assert results[0] == results[1] and {m: s for m, s, _ in results[0]} == truth


def test_large_trackers_join_by_shuffle(spark, monkeypatch):
    tracker, mail, truth = world()
    monkeypatch.setattr(K, "BROADCAST_ROWS", 0)
    assert {r.msg_id: r.source_id for r in K.link(spark.createDataFrame(mail, MAIL), spark.createDataFrame(tracker, TRACKER)).collect()} == truth


def test_empty_sides(spark):
    tracker, mail, _ = world()
    t, m = spark.createDataFrame(tracker, TRACKER), spark.createDataFrame(mail, MAIL)
    assert K.link(m.limit(0), t).count() == 0 and K.link(m, t.limit(0)).count() == 0


def text_of(level, r, n=12):
    easy, hard = "the dog ran to a big red house and sat".split(), "notwithstanding institutional heterogeneity the procedural recalibration systematically undermines counterfactual indemnification".split()
    sentence = lambda lv: " ".join(r.choice(hard if r.random() < (lv - 1) / 4 else easy) for _ in range(6 + 6 * lv)).capitalize() + "."
    return "\n".join(sentence(level) for _ in range(n))


def test_levels_hold_out(spark):
    r = random.Random(1)
    docs = [(i, text_of(1 + i % 5, r), f"s{i % 17}", 1 + i % 5) for i in range(700)]
    labelled = [(i, lv, "ann") for i, _, _, lv in docs[:500]] + [(i, lv, "bob") for i, _, _, lv in docs[:40]]
    df = spark.createDataFrame([(i, t, s) for i, t, s, _ in docs] + [(900, None, "s1"), (901, "", "s1"), (902, "short", "s1")], "doc_id int, text string, source string")
    labels = spark.createDataFrame(labelled, "doc_id int, reading_level int, rater string")
    got = {x.doc_id: x.level for x in R.levels(df, labels).collect()}
    held = docs[500:]
    assert np.mean([(got[i] >= R.DEMANDING) == (lv >= 4) for i, _, _, lv in held]) > 0.95
    assert set(got) == {i for i, *_ in docs}
    assert all(x.level is None for x in R.levels(df, labels.limit(0)).collect())
    assert R.levels(df.limit(0), labels).count() == 0


def test_stray_sentence_and_copies():
    r = random.Random(2)
    easy, stray = text_of(1, r, 20), text_of(5, r, 1)
    x = np.array([R.features_of(text_of(1 + i % 5, r)) for i in range(300)])
    g = R.fit(x, np.array([1.0 + i % 5 for i in range(300)]), np.array([f"s{i % 9}" for i in range(300)]))
    assert g.agreement > 0.95 and g.grade(np.array([R.features_of(easy + "\n" + stray)]))[0] < R.DEMANDING
    assert R.features_of(None) is None and R.features_of("one") is None and len(R.features_of(easy)) == len(R.NAMES)
    assert R.features_of(easy * 400) is not None


def test_short_pieces_only():
    assert R.features_of("Buy now\nget one\nfor less") is not None and R.features_of("two words") is None


def test_agreement_is_cross_fitted():
    r = np.random.default_rng(5)
    x, y = r.random((400, len(R.NAMES))), r.integers(1, 6, 400).astype(float)  # nothing to learn
    g = R.fit(x, y, np.array([f"s{i % 20}" for i in range(400)]))
    assert g.error > 1.1 and len(g.held) == 400


def test_isotonic():
    x, y = R.isotonic(np.array([1.0, 2, 3, 4]), np.array([1.0, 3, 2, 4]))
    assert list(y) == [1, 2.5, 4] and list(x) == [1, 2.5, 4]
